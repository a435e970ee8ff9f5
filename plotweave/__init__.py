"""plotweave: a PySpark-native engine that enriches building footprints.

Layers: ``sources`` read and write, ``functions`` are column expressions and
vectorised geometry kernels, ``operators`` are joins, reductions and repairs,
``plans`` puts them together per city, ``streaming`` feeds them incrementally.
"""
