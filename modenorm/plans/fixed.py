"""Fixed parameters of the registered check queries.

The scoring checks use one fixed mixture (rounded from a fit of
``events.value``) so that Spark and the SQL twin see identical literals and
no fit parity is needed.  Fits themselves are checked in ``tests/``.
"""

from __future__ import annotations

from modenorm.operators.model import Mixture

# The check model for events.value (modes 0..9).
FIXED_WEIGHTS = (0.1218, 0.1842, 0.2378, 0.1499, 0.1103, 0.0815, 0.0536, 0.0379, 0.0190, 0.0039)
FIXED_MEANS = (3.9, 13.1, 28.2, 48.7, 69.5, 94.6, 123.0, 159.2, 203.8, 272.7)
FIXED_SDS = (2.6, 5.5, 8.9, 9.9, 12.0, 16.4, 23.8, 34.6, 57.7, 91.3)
FIXED_OFFSETS = (-3.060886, -3.396481, -3.622377, -4.190322, -4.689458, -5.304434, -6.095892, -6.816658,
                 -8.018573, -10.060930)

# Fixed values of the derived fixtures.
HEAVY_TAIL_EVERY = 500      # every 500th event id gets its value times 40
HEAVY_TAIL_FACTOR = 40.0
MISSING_SENTINEL = -9999999.0
MIXED_MODAL = (0.0, -9999999.0)
SEED = 42


def fixed_model(col: str = "value", part: str = "main") -> Mixture:
    return Mixture(col=col, part=part, means=FIXED_MEANS, sds=FIXED_SDS, offsets=FIXED_OFFSETS,
                   weights=FIXED_WEIGHTS)
