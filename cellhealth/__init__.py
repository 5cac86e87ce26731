"""Cell-health analytics on Spark.

Battery discharge telemetry -> per-cycle records -> remaining-life and
state-of-health labels -> windowed features -> leak-free split and scaling ->
fixed-length cycle sequences -> MLlib regressors -> accuracy, end-of-life and
fleet reports.  Everything is expressed with DataFrame operators so Catalyst
plans it; per-battery windows run on bounded segments (see
``operators.segments``) so one very long battery never lands in one task.
"""

__version__ = "0.1.0"
