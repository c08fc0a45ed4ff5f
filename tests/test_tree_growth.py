import math
from pathlib import Path

import numpy as np
import pytest
from conftest import rows_of
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from skyledger.operators import tree_growth as growth
from skyledger.session import dealt_evenly, materialise
from skyledger.sources.paths import file_system


def rows(spark, n=4000):
    """Two features of few values, one of many; rows that come several times, of both classes."""
    i = F.col("id")
    late = ((i % 5 == 0) & (i % 24 > 11)) | (i % 13 == 0) | (F.xxhash64(i) % 9 == 0)
    return materialise(spark.range(n).select(
        (i % 7).alias("a"), (i % 24).alias("b"), (F.pmod(F.xxhash64("id"), F.lit(900)) / 4).alias("c"),
        late.cast("int").alias("late"), (1.0 + i % 3).alias("w"),
    ), "rows-to-grow")


def fitted(df, grown, **options):
    classifier = GBTClassifier(labelCol="late", weightCol="w", stepSize=0.3, seed=1, **options)
    stage = growth.GrownTrees(classifier) if grown else classifier
    return Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), stage]).fit(df)


def probabilities(model, df):
    return [r.probability[1] for r in model.transform(df).orderBy("a", "b", "c", "late", "w").collect()]


def same(one, other):
    return all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(one, other, strict=True))


@pytest.mark.parametrize("bins,depth", [(32, 4), (1024, 3), (8, 0)])
def test_the_trees_are_those_of_mllib(spark, bins, depth):
    df = rows(spark)
    options = dict(maxIter=5, maxDepth=depth, maxBins=bins)
    grown, theirs = fitted(df, True, **options), fitted(df, False, **options)
    assert same(probabilities(grown, df), probabilities(theirs, df))
    for own, other in zip(grown.stages[1].trees, theirs.stages[1].trees, strict=True):
        assert own.numNodes == other.numNodes and own.depth == other.depth
    assert grown.stages[1].treeWeights == theirs.stages[1].treeWeights
    assert np.allclose(grown.stages[1].featureImportances.toArray(), theirs.stages[1].featureImportances.toArray())
    assert grown.stages[1].getMaxIter() == 5 and grown.stages[1].getWeightCol() == "w"


def test_the_trees_do_not_hang_on_how_cells_are_dealt(spark, monkeypatch):
    df = rows(spark, 1500)
    plain = probabilities(fitted(df, True, maxIter=3, maxDepth=3), df)
    seen = []
    monkeypatch.setattr(growth, "dealt_evenly", lambda cells: seen.append(cells.count()) or dealt_evenly(cells, 40))
    monkeypatch.setattr(growth, "JOINT_BINS", 1)
    monkeypatch.setattr(growth, "TASKS_TO_DRIVER", 1)
    assert same(plain, probabilities(fitted(df, True, maxIter=3, maxDepth=3), df))
    assert len(seen) == 1 and 40 < seen[0] < df.count()


def test_a_pass_has_as_many_tasks_as_cores_and_notes_go_after_two_trees(spark, monkeypatch):
    """Before, every pass went over all rows, cached as objects."""
    dealt, folders = [], []
    original = growth.Passes

    class Watched(original):
        def run(self, work, *options):
            folders.append(self.folder)
            dealt.append(len(self.slices))
            assert not len(spark.sparkContext._jsc.getPersistentRDDs())
            return super().run(work, *options)

    monkeypatch.setattr(growth, "Passes", Watched)
    monkeypatch.setattr(growth, "dealt_evenly", lambda cells: dealt_evenly(cells, 20))
    fitted(rows(spark, 1500), True, maxIter=4, maxDepth=3)
    assert len(dealt) == 1 + 4 * 3 and min(dealt) == max(dealt) > spark.sparkContext.defaultParallelism
    inner = Path(file_system(folders[0])[1])
    assert sorted(p.name for p in inner.iterdir()) == ["cells", "tree-3", "tree-4"]


def test_quantiles_of_heavy_values():
    values, weights = np.arange(10.0), np.array([1, 1, 1, 50, 1, 1, 1, 1, 1, 1.0])
    found = growth.quantile_splits(values, weights, 4)
    assert len(found) <= 3 and set(found) <= set((values[1:] + values[:-1]) / 2) and 2.5 in found


def test_rows_that_can_not_be_learnt_from_are_refused(spark):
    df = rows(spark, 100)
    with pytest.raises(ValueError, match="no rows"):
        fitted(df.limit(0), True, maxIter=1)
    for broken, said in ((df.withColumn("late", F.col("late") + 1), "labels"), (df.withColumn("w", -F.col("w")), "weights"),
                         (df.withColumn("a", F.lit(None).cast("int")), "(?i)null")):
        with pytest.raises(Exception, match=said):
            fitted(broken, True, maxIter=1)


def test_one_class_and_one_value_give_leaves(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 1, 2.0)] * 5, "a int, b int, c double, late int, w double")
    grown, theirs = fitted(df, True, maxIter=2, maxDepth=3), fitted(df, False, maxIter=2, maxDepth=3)
    assert same(probabilities(grown, df), probabilities(theirs, df))
    assert [t.numNodes for t in grown.stages[1].trees] == [1, 1]
    assert rows_of(grown.transform(df).select("prediction").distinct()) == [(1.0,)]
