"""A small fixed ensemble of trees for three clusters, as rows of nodes: what Spark and DuckDB both score.

Weights, thresholds and leaves are sums of powers of two, so that no order of adding changes a score.
"""

from __future__ import annotations

from shelfcast.operators.trees import Node

# (feature, threshold, whether a missing value goes left, left, right), or a leaf's value.
TREES = {
    (0, 0, 1.0): [
        ("rolling_week_sales", 24.5, True, 1, 2),
        ("product_id", 0.5, False, 3, 4),
        ("weekly_trend", 1.25, False, 5, 6),
        4.5, 21.25, 38.0, 52.75,
    ],
    (0, 1, 0.5): [("same_last_4_days", 30.0, False, 1, 2), -3.5, ("week_old", 40.25, True, 3, 4), 6.0, -1.75],
    (0, 2, 0.25): [("day_of_week", 5.5, False, 1, 2), -0.5, 8.0],
    (2, 0, 1.0): [
        ("rolling_4_days", 25.0, False, 1, 2),
        ("rolling_6_max", 49.5, True, 3, 4),
        ("product_id", 1.5, False, 5, 6),
        12.0, 18.5, 90.25, 33.0,
    ],
    (2, 1, 0.125): [("weekend_flag", 0.5, False, 1, 2), 2.0, ("week_old", 20.0, False, 3, 4), -6.0, 10.0],
    (5, 0, 1.0): [27.5],
    (5, 1, 2.0): [("same_last_6_days", 25.5, True, 1, 2), -1.0, ("same_last_6_days", 60.0, False, 3, 4), 3.0, 0.5],
}

NODES = [
    Node(model, tree, weight, at, *split) if isinstance(split, tuple) else Node(model, tree, weight, at, value=split)
    for (model, tree, weight), splits in TREES.items()
    for at, split in enumerate(splits)
]
FEATURES = sorted({node.feature for node in NODES if node.feature})
