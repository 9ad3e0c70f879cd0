"""A run's parameters from JSON, so that a job on other tables needs no code.

The keys are the field names of :class:`~cadence.plans.pipeline.RunConfig` and
of the dataclasses in it; dates are ISO strings, missing keys keep their
defaults, unknown ones raise an error. Example::

    {"mapping": {"table": "events", "customer_id": "user_id", "date": "ts",
                 "type": "event_type", "amount": "value",
                 "windows": {"obs_end": "2024-01-22", "late_start": "2024-01-15",
                             "pred_start": "2024-01-22", "obs_periods": 3, "pred_periods": 1,
                             "early_periods": 2, "late_periods": 1}},
     "customers": {"table": "customer", "customer_id": "c_custkey", "sanity": "c_acctbal / 10000"},
     "folds_start": "2024-01-01", "fold_features": "full",
     "folds": [{"fold": 1, "obs_end": "2024-01-15", "pred_start": "2024-01-15",
                "pred_end": "2024-01-22", "obs_periods": 2, "pred_periods": 1}]}
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import fields, is_dataclass

from cadence.config import CustomerMapping, Fold, ModelParams, SignalParams, SplitSpec, TxMapping, WindowSpec
from cadence.plans.pipeline import RunConfig

_NESTED = {"mapping": TxMapping, "windows": WindowSpec, "customers": CustomerMapping, "params": ModelParams,
           "signal": SignalParams, "split": SplitSpec}
_DATES = {"obs_end", "obs_start", "late_start", "pred_start", "pred_end", "folds_start"}


def _made(kind: type, given: dict, at: str):
    assert is_dataclass(kind)
    known = {f.name for f in fields(kind)}
    for k in given:
        if k not in known:
            raise ValueError(f"{at}: unknown key {k!r}; known are {', '.join(sorted(known))}")
    values = {}
    for k, v in given.items():
        if k in _NESTED and isinstance(v, dict):
            v = _made(_NESTED[k], v, f"{at}.{k}")
        elif k == "folds":
            v = tuple(_made(Fold, f, f"{at}.folds[{i}]") for i, f in enumerate(v))
        elif k in _DATES and v is not None:
            v = dt.date.fromisoformat(v)
        elif k == "types" and v is not None:
            v = tuple(v)
        elif k == "ordinal":
            v = {c: tuple(order) for c, order in v.items()}
        values[k] = v
    return kind(**values)


def run_config(text: str) -> RunConfig:
    """The configuration that a JSON text describes."""
    given = json.loads(text)
    if not isinstance(given, dict):
        raise ValueError("a run is described by a JSON object")
    cfg = _made(RunConfig, given, "run")
    if "mapping" in given and "folds" not in given:
        raise ValueError("run: a log of its own needs its own folds")
    return cfg
