"""Fixed values. These must equal the published physics / audit constants for
results to be right; they are stated here once, as plain values."""

# --- fixed values: freezing point of sea water, T_f = L1*S + L2 + L3*P ---
LAMBDA_1 = -0.0575     # degC per PSU
LAMBDA_2 = 0.0901      # degC
LAMBDA_3 = -7.61e-4    # degC per dbar (pressure positive downward)

# --- fixed values: signal fusion ---
FUSION_MIN_MEAN_DH_M = 1e-4          # noise floor of the mascon-mean height change (m)
FFILL_COLS = ("delta_h", "ice_area", "h_surface_dynamic", "surface_slope",
              "thetao", "so", "T_f", "T_star", "lwe_length")

# --- fixed values: quality control and audit bounds ---
QC_LWE_MIN, QC_LWE_MAX = -5000.0, 5000.0       # strict open interval
LWE_TYPICAL_ABS = 200.0
HEIGHT_CHANGE_ABS_MAX = 500.0
ICE_AREA_M2_MAX = 2.0e6
ICE_AREA_FRACTION_MAX = 1.01
ICE_AREA_UNIT_SWITCH = 2.0
THETAO_MIN, THETAO_MAX = -3.5, 6.0
SO_MIN, SO_MAX = 25.0, 38.0
DIST_MAX_M = 1_500_000.0
DRAFT_MIN, DRAFT_MAX = -3000.0, 500.0
COVERAGE_WARN_PCT = 1.0
GAP_WARN_DAYS = 60

# --- fixed values: ice mask codes (0 ocean, 1 grounded, 2 rock, 3 floating) ---
MASK_GROUNDED = 1
ICE_CODES = (1, 3)
SHELF_CODES = (2, 3)

# --- fixed values: polar stereographic south (EPSG:3031) on WGS84 ---
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
TRUE_SCALE_LAT_DEG = -71.0
CENTRAL_LON_DEG = 0.0

# --- fixed values: master grid (500 m cell centres, 12288 x 12288) ---
GRID_RES = 500.0
GRID_X_MIN, GRID_X_MAX = -3072000.0, 3072000.0
GRID_Y_MIN, GRID_Y_MAX = -3072000.0, 3072000.0

# --- fixed values: time epochs of the products ---
EPOCH_ANOMALY = "2002-01-01"
EPOCH_ALTIMETRY = "2018-01-01"
