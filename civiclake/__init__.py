"""civiclake: a PySpark lakehouse for legislative open data.

Landed API pages -> bronze (conformed, deduplicated raw tables) ->
silver (cleaned dimensions and facts, deterministic keys, SCD2 history)
-> gold (report-ready metrics).  Every metric is a pure
DataFrame -> DataFrame function planned by Catalyst; nothing is
collected to the driver in a core path.
"""

__all__ = ["session", "schemas", "functions", "operators", "sources", "sinks", "plans", "streaming"]
