"""voronoi: centroid clustering (K-Means, Lloyd iteration) on Spark DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# The Arrow kernels run in executor Python workers. Pickle this package's
# functions by value so workers need no installed copy (or --py-files) of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .functions.vectors import (as_vector, check_dimensions, euclidean_distance, squared_distance,  # noqa: F401
                                vector_add, vector_scale)
from .operators.assign import assign_by_min, assign_nearest, distance_matrix  # noqa: F401
from .operators.centroids import CentroidSet  # noqa: F401
from .operators.converge import (changed_centroids, gate_on_any_change, moved_centroids,  # noqa: F401
                                 relocate_centroids)
from .operators.update import integer_mean, update_centroids, vector_mean  # noqa: F401
from .plans.cli import run_kmeans, run_kmeans_keyed  # noqa: F401
from .plans.lloyd import KMeansResult, kmeans, kmeans_keyed  # noqa: F401
