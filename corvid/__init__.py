"""corvid: Spark-native block-matrix, graph-label and ratings analytics.

Operators take and return DataFrames; nothing is collected to the driver.

    from corvid import matrix, graph, ratings, sources
    r = matrix.matrix_add(sources.read_cells(spark, m_path),
                          sources.read_cells(spark, n_path))
    sizes = graph.group_sizes(graph.min_label_groups(
        sources.read_adjacency(spark, g_path), universe="all"))
    hist = ratings.rating_histogram(sources.read_ratings(spark, r_path), mode="avg")
"""

from corvid import sources  # noqa: F401
from corvid.operators import graph, matrix, ratings  # noqa: F401

__version__ = "0.1.0"
