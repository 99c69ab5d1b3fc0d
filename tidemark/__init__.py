"""Population drift and model-monitoring analytics expressed as Spark DataFrames.

Layers, from the inside out:

* ``functions`` - column expressions (guarded ratios, hash keys, p-values);
* ``operators`` - DataFrame -> DataFrame transformations;
* ``sources``   - readers and writers for tables, batches, the run log, artifacts;
* ``plans``     - end-to-end jobs assembled from operators;
* ``streaming`` - Structured Streaming versions of the monitors.
"""

__version__ = "0.1.0"
