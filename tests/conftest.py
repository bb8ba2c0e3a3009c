import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskframe.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def model_rows(n, n_num, categories, seed=0):
    """Seeded rows with a real signal: numeric features, one category, a label."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, n_num))
    category = rng.choice(categories, size=n)
    logit = 1.5 * x[:, 0] - x[:, 1] + 0.8 * (category == categories[0])
    label = (logit + rng.logistic(size=n) > 0.5).astype(float)
    return [
        (int(i), *map(float, x[i]), str(category[i]), float(label[i])) for i in range(n)
    ], ", ".join(["row_id bigint", *[f"num_{j} double" for j in range(n_num)], "category string", "label double"])


@pytest.fixture(scope="session")
def training(spark):
    rows, schema = model_rows(300, 4, ["A", "B", "C_x"])
    df = spark.createDataFrame(rows, schema).persist()
    df.count()
    return df


NUMBERS = ["num_0", "num_1", "num_2", "num_3"]
