import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import jaccard
from demandloom.llm.components import components

from .conftest import prose


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\r", " ").replace(
        "\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and (
                    100 * len(a & b) >= 80 * len(a | b)):
                group[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted(((key, len(sets[i]), None if key is None else least[root(i)])
                   for i, (key, _) in enumerate(rows)), key=repr)


def changed(text, n, seed):
    words, pick = text.split(" "), random.Random(seed)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"e{pick.randrange(10 ** 6)}"
    return " ".join(words)


def near_groups():
    base, rows = [prose(i, 120) for i in range(6)], []
    for g, text in enumerate(base):
        for k in range(25):
            rows.append(changed(text, k % 7, 100 * g + k))
    passage = prose(99, 70)
    rows += [passage + " " + prose(200 + i, 20 + i) for i in range(30)]
    rows += [base[0], base[0].upper(), base[0].replace(" ", "\t "), prose(5, 4), prose(5, 4), prose(5, 3), "a", "A", "b"]
    # A chain whose ends are not alike, only neighbours are.
    words = prose(77, 200).split(" ")
    rows += [" ".join(words[i:i + 100]) for i in range(0, 100, 8)]
    random.Random(3).shuffle(rows)
    return list(enumerate(rows))


CASES = {
    "groups": near_groups(),
    "plain": [(3, None), (1, ""), (2, " \n"), (9, "x y"), (8, "X  y"), (7, "x y"), (5, prose(1, 5)), (4, prose(1, 6))],
    "repeated": [(1, prose(1, 50))] * 3 + [(None, prose(1, 50)), (2, prose(1, 50)), (None, None), (2, prose(2, 50))],
    "long": [(i, changed(prose(1, 20_000), 40 * i, i)) for i in range(3)],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_same_components_as_all_pairs(documents, rows, name):
    made = jaccard.similar_documents(documents(CASES[name]))
    assert rows(made, "doc_id", "n_shingles", "component_id") == brute(CASES[name])


def test_order_of_columns_does_not_change_links(documents, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_COLUMNS", 0)
    made = jaccard.similar_documents(documents(CASES["groups"]))
    assert rows(made, "doc_id", "n_shingles", "component_id") == brute(CASES["groups"])


def test_words_are_hashed_alike_whatever_the_cut(monkeypatch):
    text = prose(3, 3000).encode()
    whole = jaccard.word_hashes(text).tolist()
    monkeypatch.setattr(jaccard, "PART_BYTES", 100)
    assert jaccard.word_hashes(text).tolist() == whole
    words = text.lower().split()
    assert len(whole) == len(words) and len(set(whole)) == len(set(words))


def test_keeps_one_of_each_group_with_its_columns(documents, rows):
    table = documents(CASES["groups"])
    kept = jaccard.keep_one_of_each(table)
    assert kept.columns == table.columns
    assert rows(kept, "doc_id") == sorted({(c,) for _, _, c in brute(CASES["groups"])}, key=repr)
    again = jaccard.keep_one_of_each(documents(CASES["repeated"]))
    assert sorted(r["doc_id"] or -1 for r in again.collect()) == [-1, -1, 1, 2]


def test_texts_that_share_an_id_are_not_taken_for_one(documents, rows):
    a, b, c = prose(31, 120), prose(32, 120), prose(33, 120)
    near = a + " and a few more words"
    table = documents([(3, a), (5, near), (5, b), (6, b), (7, c), (7, c), (8, None), (8, None), (8, ""), (None, a)])
    assert rows(jaccard.similar_documents(table), "doc_id", "component_id") == sorted(
        [(3, 3), (5, 3), (5, 5), (6, 5), (7, 7), (7, 7), (8, 8), (8, 8), (8, 8), (None, None)], key=repr)
    kept = jaccard.keep_one_of_each(table.withColumns({"row": F.lit(1), "label": F.lit("x"), "node": F.lit(2)}))
    assert rows(kept, "doc_id", "text") == sorted([(3, a), (5, b), (7, c), (8, None), (8, ""), (None, a)], key=repr)
    both = documents([(5, a), (5, c)])
    assert rows(jaccard.keep_one_of_each(both), "doc_id", "text") == sorted([(5, a), (5, c)], key=repr)
    one = documents([(5, a), (5, near)])
    assert jaccard.keep_one_of_each(one).count() == 1


def test_components_of_chains_stars_and_loops(spark, rows):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    made = components(spark.createDataFrame(links, "a long, b long"))
    expected = [(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 160)] + [(200, 200), (201, 200)]
    assert rows(made, "node", "label") == sorted(expected, key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_repeated_numbers_are_counted_in_little_more_room_than_they_take():
    numbers = np.random.default_rng(1)
    held = [numbers.integers(0, 1 << 40, 1000) for _ in range(500)] + [np.arange(5), np.arange(3), np.arange(1)]
    values, n = np.unique(np.concatenate(held), return_counts=True)
    tracemalloc.start()
    column, count = jaccard._repeated(held)
    taken = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert column.tolist() == values[n > 1].tolist() and count.tolist() == n[n > 1].tolist()
    assert taken < 1.5 * 8 * len(values)
    column, count = jaccard._repeated([np.arange(3)])
    assert not len(column) and not len(count)
