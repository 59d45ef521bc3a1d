"""Equipment-health analytics on Spark.

DataFrame-in, DataFrame-out operators for vibration monitoring: reshaping long
sensor readings, aligning them with sparse health ratings, bucketing, waveform
metrics, spectra, distribution profiles and per-rating regression.
"""

__version__ = "0.1.0"
