"""DataFrame -> DataFrame operators.

* ``joins``       size-checked lookups (no hints on growing sides)
* ``dedup``       keep-latest / natural-key dedup as partial aggregations
* ``dims``        dimension extraction with deterministic keys
* ``stats``       group statistics joined back: z-score outliers
* ``diversity``   Herfindahl / Simpson indices without self-joins
* ``alignment``   front vs house voting shares
* ``engagement``  min-max and weighted scores, monthly trend
* ``reports``     rankings, spend breakdowns, calendars, dashboard figures
* ``events``      event fact, attendance, front atlas
* ``quality``     duplicate keys, orphans, rejects, profiles, layer totals
* ``sequence``    previous/next row and change points per key, skew-safe
* ``scd2``        SCD2 snapshot, history, merge, as-was lookup
"""
