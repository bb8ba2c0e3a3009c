import pytest

from riskframe.errors import ThresholdSelectionError
from riskframe.operators import threshold

LABELS = [0, 0, 0, 1, 1, 1, 1, 0, 1, 0]
SCORES = [.1, .2, .4, .9, .8, .6, .55, .3, .7, .45]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(zip(LABELS, SCORES)), "label int, p double").persist()


@pytest.fixture(scope="module")
def table(rows):
    return threshold.sweep(rows).persist()


def test_sweep(table):
    got = table.orderBy("threshold").collect()
    assert table.columns == ["threshold", "precision", "recall", "f1", "tp", "fp", "tn", "fn"]
    assert len(got) == 99
    positives = [r["tp"] + r["fp"] for r in got]
    assert positives == sorted(positives, reverse=True)
    at_half = next(r for r in got if r["threshold"] == 0.5)
    assert (at_half["precision"], at_half["recall"]) == (1.0, 1.0)


def test_best_f1_takes_the_smallest_threshold(table):
    row = threshold.select_threshold(table, "maximize_f1").first()
    assert row["threshold"] == 0.46 and row["f1"] == 1.0 and row["rationale"]


def test_floors(table):
    row = threshold.select_threshold(table, "min_recall", min_recall=1.0).first()
    assert row["recall"] == 1.0 and row["precision"] == 1.0
    row = threshold.select_threshold(table, "min_precision", min_precision=1.0).first()
    assert row["precision"] == 1.0 and row["recall"] == 1.0
    with pytest.raises(ThresholdSelectionError):
        threshold.select_threshold(table, "min_recall", min_recall=1.01)


def test_cost_youden_fixed(rows, table):
    assert threshold.select_threshold(table, "cost_based", cost_fp=1, cost_fn=5).first()["fn"] == 0
    assert threshold.select_threshold(table, "youden_j").first()["threshold"] == 0.46
    _, chosen = threshold.choose(rows, "fixed", fixed_threshold=0.425)
    assert chosen.first()["threshold"] == 0.425 and chosen.first()["fp"] == 1
    with pytest.raises(KeyError):
        threshold.select_threshold(table, "cost_based")
    with pytest.raises(ValueError):
        threshold.select_threshold(table, "nope")


def test_apply(rows):
    got = threshold.apply_threshold(rows, 0.55).orderBy("p").collect()
    assert [r["prediction"] for r in got] == [0] * 5 + [1] * 5
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            threshold.apply_threshold(rows, bad)


def test_save_and_load(spark, table, tmp_path):
    chosen = threshold.select_threshold(table)
    threshold.save_threshold(chosen, table, str(tmp_path / "t"), {"version": "v1"})
    document = threshold.load_threshold(spark, str(tmp_path / "t"))
    assert document["threshold"] == 0.46 and document["metadata"] == {"version": "v1"}
    assert document["metrics_at_threshold"]["tp"] == 5
    assert spark.read.csv(str(tmp_path / "t/evaluation_table"), header=True).count() == 99


def test_tradeoff_marks_one_row(table):
    rows = threshold.tradeoff_table(table, 0.304).where("selected").collect()
    assert [r["threshold"] for r in rows] == [0.3]


def test_missing_scores_fail(spark):
    df = spark.createDataFrame([(1, 0.5), (0, None)], "label int, p double")
    with pytest.raises(Exception, match="must hold a score"):
        threshold.sweep(df).collect()
