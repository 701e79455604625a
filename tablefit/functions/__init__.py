"""Column expressions: metrics, Normal densities, grids and the scaler."""

from tablefit.functions.stats import (  # noqa: F401
    linspace_point,
    normal_logpdf,
    normal_nll,
    normal_pdf,
    r2,
    rmse,
    sse,
)
from tablefit.functions.scaler import Scaler, fit_scaler  # noqa: F401
