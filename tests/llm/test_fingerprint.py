import hashlib
import random

import pytest

from demandloom.llm import fingerprint as fp

from .conftest import prose


def order(rows):
    return sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def brute(rows):
    ordered, out = order(rows), []
    for i, (key, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b, c = (fp.fingerprint(t) for t in (text, edited, following))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b,
                    fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=repr)


TABLES = {
    "mixed": [(i, t) for i, t in enumerate(
        [None, "", "x", "one line", prose(1, 300), prose(1, 300), prose(2, 40), "é🤗" * 50, "\n\n\n", prose(3, 20_000),
         "a\r\nb\x0b c", " "])],
    "single": [(5, prose(4, 100))],
    "ties": [(1, "b b"), (1, "a a"), (1, "a a"), (None, "n"), (None, None), (0, "z"), (7, "y")],
    "gaps": [(i * i * 1000 - 7, prose(i, 30 + i)) for i in range(60)],
    "empty": [],
}


@pytest.mark.parametrize("blocks", [1, 5, None])
@pytest.mark.parametrize("name", TABLES)
def test_same_as_brute_force(documents, rows, name, blocks):
    assert rows(fp.compare_in_order(documents(TABLES[name]), blocks=blocks)) == brute(TABLES[name])


def test_roots_tell_equal_texts_and_trees_survive_printing():
    texts = ["", "a", "a\n", "a\n\nb", "a\nb", "b\na", prose(1, 500), prose(1, 501)]
    printed = [fp.fingerprint(t) for t in texts]
    assert len({p.partition("=")[0] for p in printed}) == len(texts)
    for text, p in zip(texts, printed, strict=True):
        tree = fp.decode(p)
        assert fp.encode(tree) == p and tree.size == len(text)
        assert fp.likeness(p, fp.fingerprint(text)) == 1


def test_differing_branches_locate_an_edit():
    text = prose(9, 2000)
    for at in (0, 3000, len(text) - 5):
        changed = text[:at] + "CHANGED" + text[at + 3:]
        spans = fp.edits(fp.fingerprint(text), fp.fingerprint(changed))
        old = [(a, b) for side, a, b in spans if side == "old"]
        assert any(a <= at < b for a, b in old) and sum(b - a for a, b in old) < 1200
        # Outside the spans nothing differs.
        kept = [t for t in (text[:old[0][0]], text[old[-1][1]:]) if t]
        assert all(k in changed for k in kept)
    assert fp.edits(fp.fingerprint(text), fp.fingerprint(text)) == []


def test_likeness_follows_the_shared_text():
    random.seed(1)
    text = prose(11, 3000)
    half = fp.edited_half(text, prose(12, 3000))
    assert 0.35 < fp.likeness(fp.fingerprint(text), fp.fingerprint(half)) < 0.6
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(prose(13, 3000))) < 0.05


def unspaced(seed, n):
    pick = random.Random(seed)
    return "".join(chr(0x4E00 + pick.randrange(2000)) for _ in range(n))


def test_unspaced_and_short_texts_keep_what_they_share():
    def edited(a, b):
        return fp.likeness(fp.fingerprint(a), fp.fingerprint(fp.edited_half(a, b)))

    assert edited(unspaced(1, 699), unspaced(2, 699)) > 0.3
    marked = "。".join(unspaced(i, 30) for i in range(40))
    assert edited(marked, unspaced(3, 2000)) > 0.4
    for i in range(50):
        assert edited(prose(i, 60).replace(".", "")[:40 + i], prose(i + 100, 60)) > 0
    for text in (unspaced(4, 3000), prose(5, 900).replace(" ", "").replace(".\n", ""),
                 prose(6, 900).replace(".\n", ""), "ab" * 1500):
        for at in (1, 20, 700):
            assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text[:at] + "界" + text[at:])) > 0.8


def test_leaves_join_to_the_text():
    for text in ("", "a", "a b. c", unspaced(7, 5000), "x" * 3000, prose(8, 500), "。。a。"):
        for at in (0, 100, 600):
            assert "".join(fp._leaves(text, at)) == text


def test_clashing_columns(spark):
    table = spark.createDataFrame([(1, "a b", 5, True, "k")], "doc_id long, text string, block int, borrowed boolean, key string")
    assert fp.compare_in_order(table).count() == fp.fingerprints(table).count() == 1


def test_leaves_of_sentences_known_already_are_not_hashed_again(monkeypatch):
    texts = [prose(11, 3000), prose(12, 3000), "short. é🤗. " * 30, "x" * 5000, prose(13, 200), "", "a\n\nb. c"]
    hashed = []
    plain = fp._hash
    monkeypatch.setattr(fp, "_hash", lambda data, kind: (hashed.append(kind), plain(data, kind))[1])
    for one in texts:
        for other in texts:
            known, known_other, edited = {}, {}, fp.edited_half(one, other)
            fp.tree(one, known), fp.tree(other, known_other)
            hashed.clear()
            whole = fp.tree(edited)
            alone = hashed.count(b"leaf")
            hashed.clear()
            assert fp.tree(edited, known | known_other) == whole
            if one == texts[0] and other == texts[1]:
                assert hashed.count(b"leaf") < alone / 4
