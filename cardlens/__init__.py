"""cardlens: card-transaction fraud analytics as Spark DataFrame operators.

Subpackages: ``sources`` (inputs and sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans``
(stage composition and registered queries), ``streaming`` (the transform
over a file stream).
"""
