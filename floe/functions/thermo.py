"""Surface, draft, pressure, freezing point and thermal driving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from floe import constants as C
from floe.functions.grid import col


def dynamic_surface(surface="surface", delta_h="delta_h") -> Column:
    """static surface plus height change."""
    return col(surface) + col(delta_h)


def ice_draft(surface="surface", thickness="thickness") -> Column:
    """draft = surface - thickness."""
    return col(surface) - col(thickness)


def base_pressure(draft="ice_draft") -> Column:
    """pressure (dbar ~ m) at the ice base, max(0, -draft); null stays null."""
    d = col(draft)
    return F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))


def freezing_point(so="so", pressure="pressure") -> Column:
    """T_f = L1*S + L2 + L3*P, stored as FLOAT."""
    t = F.lit(C.LAMBDA_1) * col(so) + F.lit(C.LAMBDA_2) + F.lit(C.LAMBDA_3) * col(pressure)
    return t.cast("float")


def thermal_driving(thetao="thetao", t_f="T_f") -> Column:
    """F8: T* = thetao - T_f (T_f taken as the stored FLOAT), stored as FLOAT."""
    return (col(thetao) - col(t_f).cast("double")).cast("float")
