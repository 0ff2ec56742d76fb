import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandloom.llm import chunk_bpe

from .conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = chunk_bpe.ChunkEncoder(PATH)
TEXTS = ["", " ", "'", "a<|endoftext|>b", "<|endoftext|>" * 3, "<|endoftext", prose(1, 20_000),
         "ab" * 100_000, "a" + "\n" * 200_000 + "b", "你好，世界。" * 5_000, "don't we'll x's 'r'e" * 3_000,
         "\x1c a b c　d\x85" * 999, "‘’…é🙂" * 20_000, "\u0000x  \t", "ⅷ²½٣x२" * 3_000, "日本語テスト" * 9_000]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_same_ids_as_the_library(text):
    assert ENCODER.encode(text) == library(text)
    assert ENCODER.decode(ENCODER.encode(text)) == LIBRARY.decode(library(text), skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, LIBRARY.get_vocab_size() + 5), st.integers(0, 260)), max_size=50))
def test_any_ids_are_decoded_as_by_the_library(ids):
    assert ENCODER.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_ids_of_the_vocabulary_are_decoded_without_the_library(monkeypatch):
    ids = [i for text in TEXTS[:7] for i in library(text)] + list(LIBRARY.get_vocab().values())
    expected = LIBRARY.decode(ids, skip_special_tokens=False)
    monkeypatch.setattr(ENCODER, "library", None)
    assert ENCODER.decode(ids) == expected
    assert ENCODER.listed(ids) == ",".join(map(str, ids))


def test_three_million_spaces():
    text = "a" + " " * 3_000_000 + "b"
    assert ENCODER.encode(text) == library(text)


@pytest.mark.parametrize("bits", [1, 3])
def test_any_cut_gives_the_same_ids(bits, monkeypatch):
    monkeypatch.setattr(chunk_bpe, "CUT_BITS", bits)
    monkeypatch.setattr(chunk_bpe, "SHORTEST", 1)
    monkeypatch.setattr(chunk_bpe, "LONGEST", 7)
    small = chunk_bpe.ChunkEncoder(PATH, chunk_memory=50, join_memory=20)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from("  \n'aehinorstdlmv.,»é你1２"),
                                      st.characters(exclude_categories=["Cs"])), max_size=200))
    def same(text):
        assert "".join(chunk_bpe.cut(text)) == text
        assert small.encode(text) == library(text)

    same()


def test_chunks_are_cut_by_content():
    text, lead = prose(2, 30_000), "Something new stands here. "
    before, after = chunk_bpe.cut(text), chunk_bpe.cut(lead + text)
    assert "".join(after) == lead + text
    assert len(set(before) - set(after)) <= 2
    assert max(map(len, chunk_bpe.cut("x" * 100_000))) <= chunk_bpe.LONGEST


def test_places_do_not_depend_on_the_parts_that_are_hashed(monkeypatch):
    text = prose(3, 3_000)
    whole = chunk_bpe.cut_places(text)
    monkeypatch.setattr(chunk_bpe, "HASH_PART", 100)
    assert chunk_bpe.cut_places(text) == whole


def test_shared_chunks_are_encoded_once():
    encoder = chunk_bpe.ChunkEncoder(PATH)
    shared = prose(4, 5_000)
    encoder.encode("First text. " + shared)
    done = encoder.encoded
    assert encoder.encode("Another beginning of it. " + shared) == library("Another beginning of it. " + shared)
    assert encoder.encoded - done < 0.1 * len(shared) and encoder.reused > 0.9 * len(shared)


def test_memory_is_bounded_and_does_not_change_ids():
    small = chunk_bpe.ChunkEncoder(PATH, chunk_memory=2_000, join_memory=100)
    for text in TEXTS[:7] * 2 + [prose(5, 9_000)]:
        assert small.encode(text) == library(text)
    assert sum(map(len, small.chunks.young)) <= 2_000 + chunk_bpe.LONGEST


def test_other_vocabularies_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        changed = file.read().replace('"add_prefix_space":false', '"add_prefix_space":true').replace(
            '"add_prefix_space": false', '"add_prefix_space": true')
    (tmp_path / "other.json").write_text(changed, encoding="utf-8")
    with pytest.raises(ValueError, match="byte-level"):
        chunk_bpe.ChunkEncoder(str(tmp_path / "other.json"))


def test_tables(spark, rows):
    listed = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (0, "again"), (0, "again")]
    table = spark.createDataFrame([(k, t, 1, "x") for k, t in listed],
                                  "doc_id long, text string, n_tokens long, ids string")
    ids = [(k, library(t or "")) for k, t in listed]
    assert rows(chunk_bpe.encode_table(table, PATH)) == sorted(
        ((k, i, t or "") for (k, t), (_, i) in zip(listed, ids, strict=True)), key=repr)
    assert rows(chunk_bpe.digest_table(table, PATH)) == sorted(((
        k, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
        hashlib.sha256((t or "").encode()).hexdigest())
        for (k, t), (_, i) in zip(listed, ids, strict=True)), key=repr)
    assert chunk_bpe.digest_table(table.limit(0), PATH).collect() == []
