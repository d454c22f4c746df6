"""Plans: how the operators are wired together.

* ``roles``     driver test tables -> domain-shaped frames (and silver tables)
* ``silver``    silver builders V1-V15 over bronze frames
* ``gold``      gold builders of both generations over silver frames
* ``layers``    bronze -> silver -> gold (+ audit) runner with a status frame
* ``registry``  the registered queries, each with its SQL oracle
"""
