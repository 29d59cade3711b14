from __future__ import annotations

import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from segmentry import get_spark

    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def empty_cache(spark):
    yield
    spark.catalog.clearCache()


@pytest.fixture(scope="session")
def blobs():
    """Three separated groups, scattered noise, a pile of copies and a coarse lattice."""
    rng = np.random.default_rng(3)
    groups = [rng.normal(c, 0.35, (150, 2)) for c in ((0, 0), (4, 4), (0, 5))]
    x = np.vstack(groups)
    extra = [rng.uniform(-3, 8, (40, 2)), np.repeat(x[:1], 200, axis=0), np.round(rng.uniform(0, 3, (60, 2))) + 10]
    return np.vstack([x, *extra]), np.repeat([0, 1, 2], 150)


def points(spark, x, parts: int = 3):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, features array<double>").repartition(parts)


def labels_of(df) -> np.ndarray:
    return np.array([r["cluster"] for r in df.orderBy("id").collect()])


def same_partition(a, b) -> bool:
    """Equal up to renaming the labels."""
    pairs = set(zip(list(a), list(b)))
    return len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})
