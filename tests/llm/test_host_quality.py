import re
from collections import Counter

from pyspark.sql import functions as F

from demandloom.llm import host_quality

from .conftest import prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


TEXTS = [
    None, "", " \n\t ", "one", "a b c", "a b c a b c", "x " * 200, "a b c d 🤗#*", "\n\n a \n a\n\na \n",
    prose(1, 400), prose(2, 60) + "\n" + prose(2, 60), "a b a b a b a b", prose(3, 30_000),
    "\u000b\u000c".join(["p", "q", "r"] * 30), "| # * $ % & < >",
]


def test_measures_are_those_of_brute_force(documents, rows):
    table = documents([(i, t, f"s{i % 3}") for i, t in enumerate(TEXTS)])
    made = host_quality.apply_quality_rules(table, carry=("doc_id",))
    assert rows(made, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed") == sorted(((i, *brute(t)) for i, t in enumerate(TEXTS)), key=repr)


def test_bad_hosts_lose_their_good_documents_and_small_ones_do_not(documents, spark, rows):
    good, table, n = prose(5, 80), [], 0
    for host, passed, failed in (("good", 60, 2), ("fair", 40, 20), ("bad", 2, 58), ("tiny", 0, 1), (None, 30, 1)):
        for text in [good] * passed + [""] * failed:
            table.append((n, text, host))
            n += 1
    made = host_quality.apply_quality_rules(documents(table), carry=("doc_id", "source"))
    kept = {r["source"]: r["n"] for r in made.filter("kept").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert kept == {"good": 60, "fair": 40, None: 30}
    verdicts = {r["host"]: r for r in host_quality.host_verdicts(
        made.select("source", "base_failed"), "source", "base_failed").collect()}
    assert verdicts["bad"]["host_rejected"] and not verdicts["tiny"]["host_rejected"]
    assert 0.2 < verdicts["tiny"]["failure_rate"] < 0.8


def test_keeps_rows_and_columns_of_their_own(spark):
    text = prose(6, 80)
    table = spark.createDataFrame([(1, text, "a", 9, True)] * 2 + [(2, "", "a", 9, True)],
                                  "doc_id long, text string, source string, n_words long, kept boolean")
    made = host_quality.keep_good(table)
    assert made.columns == table.columns
    assert made.collect() == [(1, text, "a", 9, True)] * 2
    assert host_quality.keep_good(table.limit(0)).collect() == []


def test_weight_of_the_prior_leaves_chance_out(spark):
    # Rates of small hosts that differ by chance only: they are taken for equal, so no host is condemned.
    rows = [(h, (h * 7 + i * 5) % 8 == 0) for h in range(200) for i in range(3)]
    found = host_quality.host_verdicts(spark.createDataFrame(rows, "host long, failed boolean"), "host", "failed").collect()
    mean = sum(f for _, f in rows) / len(rows)
    assert len(found) == 200 and all(abs(r["failure_rate"] - mean) < 0.01 for r in found)
    assert not any(r["host_rejected"] for r in found)


def test_a_host_must_be_worse_than_the_others(spark):
    rows = [(h, i % 10 < 7) for h in range(5) for i in range(200)]
    verdicts = host_quality.host_verdicts(spark.createDataFrame(rows, "host long, failed boolean"), "host", "failed")
    assert verdicts.filter("host_rejected").count() == 0
    for same in (True, False):
        one = spark.createDataFrame([(1, same)] * 9, "host long, failed boolean")
        assert [r["host_rejected"] for r in host_quality.host_verdicts(one, "host", "failed").collect()] == [False]


def test_own_columns_may_have_the_names_of_measures(spark):
    table = spark.createDataFrame([(1, prose(6, 80), "a", "h", 7)], "doc_id long, text string, host string, source string, n_symbols long")
    made = host_quality.apply_quality_rules(table.withColumnRenamed("n_symbols", "base"), carry=("doc_id", "host", "base"))
    assert [(r["doc_id"], r["host"], r["base"], r["kept"]) for r in made.collect()] == [(1, "a", 7, True)]
