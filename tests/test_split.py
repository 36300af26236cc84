import hashlib
import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabaudit.operators import split


def class_order(label):
    return (label is None, label if label is not None else 0)


def class_quotas(sizes, test_size):
    """Test rows per class: proportional, the total rounded up, largest remainders first."""
    n = sum(sizes.values())
    total = math.ceil(test_size * n)
    quotas = {c: size * total // n for c, size in sizes.items()}
    by_remainder = sorted(sizes, key=lambda c: (-(sizes[c] * total % n), class_order(c)))
    for c in by_remainder[: total - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def fold_sizes(train_sizes, k):
    """Rows per class and fold: the training labels, sorted, are dealt out in turn."""
    out, start = {}, 0
    for c in sorted(train_sizes, key=class_order):
        end = start + train_sizes[c]
        out[c] = [len(range(start + (i - start) % k, end, k)) for i in range(k)]
        start = end
    return out


def naive(rows, k, test_size=0.2, seed=42):
    """Sort every class by hash, take the quota, cut the rest into blocks."""
    classes = {}
    for key, label in rows:
        classes.setdefault(label, []).append(key)
    quotas = class_quotas({c: len(keys) for c, keys in classes.items()}, test_size)
    sizes = fold_sizes({c: len(keys) - quotas[c] for c, keys in classes.items()}, k)
    out = {}
    for label, keys in classes.items():
        ordered = sorted(keys, key=lambda key: hashlib.md5(f"{seed}|{key}".encode()).hexdigest())
        folds = [None] * quotas[label]
        for i, size in enumerate(sizes[label]):
            folds += [i] * size
        for key, fold in zip(ordered, folds):
            out[key] = ("test" if fold is None else "train", fold)
    return out


def placed(df):
    return {r["id"]: (r["part"], r["fold"]) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    # One class holds a third of the rows, another a single row; one label is missing.
    def label(i):
        return "hot" if i % 3 == 0 else "lone" if i == 1 else None if i % 50 == 2 else f"c{i % 7}"

    return [(i, label(i)) for i in range(2000)]


def test_matches_sorting_each_class(spark, rows):
    df = spark.createDataFrame(rows, "id long, label string")
    assert placed(split.stratified_folds(df, "label", "id")) == naive(rows, 5)


def test_partitions_do_not_matter(spark, rows):
    df = spark.createDataFrame(rows, "id long, label string")
    results = []
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        shuffled = df.repartition(n, F.xxhash64("id", F.lit(n)))
        results.append(placed(split.stratified_folds(shuffled, "label", "id")))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_another_seed_gives_another_split_of_the_same_size(spark, rows):
    df = spark.createDataFrame(rows, "id long, label string")
    a = split.stratified_split(df, "label", "id", seed=1)
    b = split.stratified_split(df, "label", "id", seed=2)
    tests = [{r["id"] for r in x.filter("part = 'test'").collect()} for x in (a, b)]
    assert len(tests[0]) == len(tests[1]) == 400 and tests[0] != tests[1]


def test_many_classes_are_joined(spark):
    rows = [(i, i % 80) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, label int")
    out = split.stratified_folds(df, "label", "id", k=2)
    assert placed(out) == naive(rows, 2)
    assert out.columns == ["id", "label", "part", "fold"]


def test_labelling_needs_no_shuffle(spark, rows):
    df = spark.createDataFrame(rows, "id long, label string")
    out = split.fit_split(df, "label", "id", folds=5).apply(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_train_test(spark, rows):
    df = spark.createDataFrame(rows, "id long, label string")
    train, test = split.train_test(split.stratified_split(df, "label", "id"))
    assert train.count() == 1600 and test.count() == 400
    assert train.columns == ["id", "label"]


def test_published_test_size():
    """48,842 rows leave 9,769 for the test, 2,338 of them positive."""
    quotas = class_quotas({"<=50K": 37155, ">50K": 11687}, 0.2)
    assert quotas == {"<=50K": 7431, ">50K": 2338}


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.text(max_size=3), st.integers(1, 500), min_size=1, max_size=8),
    st.integers(2, 10),
)
def test_quotas_and_folds_add_up(sizes, k):
    quotas = class_quotas(sizes, 0.2)
    n = sum(sizes.values())
    total = -(-n // 5)
    assert sum(quotas.values()) == total
    for c, size in sizes.items():
        assert 0 <= quotas[c] <= size
        assert abs(quotas[c] - size * total / n) < 1
    folds = fold_sizes(sizes, k)
    assert {c: sum(f) for c, f in folds.items()} == sizes
    per_fold = Counter({i: sum(f[i] for f in folds.values()) for i in range(k)})
    assert max(per_fold.values()) - min(per_fold.values()) <= 1


def test_thousands_of_classes_and_text_keys(spark):
    rows = [(f"k{i}", f"class {i % 3000}") for i in range(7000)]
    df = spark.createDataFrame(rows, "id string, label string")
    assert placed(split.stratified_folds(df, "label", "id", k=3)) == naive(rows, 3)


def test_null_and_repeated_keys_raise(spark):
    df = spark.createDataFrame([(i if i % 10 else None, i % 2) for i in range(100)], "id long, label int")
    with pytest.raises(ValueError, match="have no id"):
        split.stratified_split(df, "label", "id")
    same = spark.createDataFrame([(1, 0)] * 50, "id long, label int")
    with pytest.raises(Exception, match="repeats"):
        split.stratified_split(same, "label", "id")
