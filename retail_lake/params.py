"""Run parameters that the reference took from the clock.

The reference stamps rows with CURRENT_TIMESTAMP() and filters on
CURRENT_DATE(); that makes reruns non-reproducible. Here they are explicit
inputs with a "now" default for production runs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values used by the reference models.
USD_TO_INR = 83.5          # flat USD -> INR rate in the sales fact
RECENT_SALES_DAYS = 30     # "last 30 days" window of the inventory analysis
MOVING_AVG_ROWS = 7        # ROWS BETWEEN 6 PRECEDING AND CURRENT ROW

# Fixed run parameters of the fixture queries (deterministic results).
FIXTURE_LOAD_TS = dt.datetime(2001, 8, 1, 6, 0, 0)
FIXTURE_AS_OF = dt.date(2001, 8, 1)


@dataclass(frozen=True)
class RunParams:
    load_ts: dt.datetime = field(default_factory=lambda: dt.datetime.now().replace(microsecond=0))
    as_of: dt.date = field(default_factory=dt.date.today)
    usd_inr: float = USD_TO_INR


FIXTURE_PARAMS = RunParams(load_ts=FIXTURE_LOAD_TS, as_of=FIXTURE_AS_OF, usd_inr=USD_TO_INR)
