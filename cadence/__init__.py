"""cadence — client-signal analytics as Spark DataFrame operators.

From a customer table and a transaction log: leakage-safe behaviour features
and labels, MLlib models with calibration and walk-forward validation, and a
rule-based signal layer that ranks customers by risk-adjusted expected value.
"""

__version__ = "0.1.0"
