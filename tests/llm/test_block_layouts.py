"""Blocks of benchmark items over documents whose scan is split differently from job to job."""

from shardloom.llm import decontaminate as dc
from tests.llm import brute

SETTINGS = {"spark.sql.files.openCostInBytes": ("1b", "4m"), "spark.sql.files.maxPartitionBytes": ("1m", "128m")}


def test_blocks_do_not_depend_on_the_layout(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i} has passage number p{i % 7} inside and more words q{i % 5} here") for i in range(40)]
    items = [(k, f"passage number p{k}") for k in range(7)] + [(10 + k, f"more words q{k}") for k in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(20).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    before, turn, write = {k: spark.conf.get(k) for k in SETTINGS}, [0], dc.as_written

    def shifting(df, label):
        turn[0] += 1
        spark.conf.set("spark.sql.files.minPartitionNum", str((1, 40)[turn[0] % 2]))
        for k, v in SETTINGS.items():
            spark.conf.set(k, v[turn[0] % 2])
        return write(df, label)

    monkeypatch.setattr(dc, "as_written", shifting)
    try:
        got = dc.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), block_words=6).drop("spans").collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert turn[0] > 4 and brute.in_order(map(tuple, got)) == brute.in_order(brute.contamination(rows, items))


def test_long_items_and_many_blocks(spark):
    """Items longer than an automaton are cut so that no window is lost."""
    import random

    from shardloom.llm.decontaminate import contamination
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(40)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((300, 5, 13, 90, 1, 0, 64))]
    docs = [(k, " ".join([word() for _ in range(30)] + items[k % 7][1].split()[k:k + 20] + [word() for _ in range(9)])) for k in range(60)]
    want = brute.contamination(docs, items)
    rows, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (13, 40, 100_000):
        got = contamination(rows, bench, block_words=most).drop("spans").collect()
        assert brute.in_order(map(tuple, got)) == brute.in_order(want)


def test_cleaned_texts(spark):
    from shardloom.llm.decontaminate import decontaminated
    item = "One two, three four five six seven eight nine ten eleven twelve thirteen"
    long = "other words " * 200
    docs = [(1, f"{long}: {item.upper()}! the end", "a", 7), (2, f"before {item} after", "b", 8), (3, None, None, None), (4, "", "c", 0), (5, long, None, 9)]
    rows = spark.createDataFrame(docs, "k long, text string, more string, n_chars int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminated(rows, bench, "k", size_col="n_chars")
    assert got.columns == rows.columns
    cut = f"{long}: the end"
    assert brute.in_order(map(tuple, got.collect())) == brute.in_order([(1, cut, "a", len(cut)), *docs[2:]])
    assert decontaminated(rows, bench.filter("false"), "k").count() == 5 and decontaminated(rows.filter("false"), bench, "k").count() == 0
