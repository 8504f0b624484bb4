"""cofan: co-rating analytics on Spark.

Lazy DataFrame plans over a ratings fact table and a movies dimension:
similar-item ("fans of X also liked") recommendation for one seed or a whole
table of seeds, popularity rankings, input contracts and data-quality
profiles, title and genre functions, catalogue best-match selection and an
ALS model workflow.  Every public function takes DataFrames (or a session and
paths) and returns a DataFrame; nothing but final results reaches the driver.
"""

__version__ = "0.1.0"
