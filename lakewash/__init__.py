"""lakewash: record cleansing and loading as native Spark plans.

Layout:

* ``lakewash.functions`` - cleaners: ``Column`` in, ``Column`` out.
* ``lakewash.operators`` - frame shaping (mapping, nesting, ids) and checks.
* ``lakewash.sources``   - readers and sinks.
* ``lakewash.plans``     - whole jobs, plus the query catalog used for checks.
* ``lakewash.streaming`` - the same jobs over ``readStream``.
"""

__version__ = "0.1.0"
