import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import piece_bpe

from .conftest import prose

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER = piece_bpe.PieceEncoder(PATH)
TEXTS = ["", " ", "  a  b   ", "a\n\n b\t c", "▁▁ x▁y", "日本語 テスト 🤗 é", "\u0000x", "aaaa" * 1000, " " * 3000,
         "<s>[INST] <0x0A> </s>", "a1b_c-d__12 _x", "²³ⅷ x²", "».», “”.", prose(1, 20_000), "x" * 100_000]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_same_ids_as_the_library(text):
    assert ENCODER.encode(text) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("  \n▁aehinorst.,»”éß1"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_same_ids_for_any_text(text):
    assert ENCODER.encode(text) == LIBRARY.encode(text)


def test_memory_does_not_change_ids(monkeypatch):
    monkeypatch.setattr(piece_bpe, "MEMORY_WORDS", 5)
    small = piece_bpe.PieceEncoder(PATH)
    for text in TEXTS * 2:
        assert small.encode(text) == LIBRARY.encode(text)


def test_tables(documents, rows):
    listed = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (0, "again"), (0, "again")]
    table = documents(listed)
    ids = [(k, LIBRARY.encode(t or "")) for k, t in listed]
    made = piece_bpe.encode_table(table, PATH)
    assert rows(made) == sorted(((k, i, LIBRARY.decode(i)) for k, i in ids), key=repr)
    digests = piece_bpe.digest_table(table, PATH)
    assert rows(digests) == sorted(((
        k, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
        hashlib.sha256(LIBRARY.decode(i).encode()).hexdigest()) for k, i in ids), key=repr)
    assert piece_bpe.digest_table(documents([]), PATH).collect() == []


def test_check_finds_a_wrong_word():
    with pytest.raises(ValueError, match="library encodes"):
        ENCODER.check({"▁the": (1, 2, 3)})


def test_words_without_the_prefix_are_checked_with_the_word_before(monkeypatch):
    seen = []
    encoder = piece_bpe.PieceEncoder(PATH)
    monkeypatch.setattr(piece_bpe, "encoder_of", lambda path: encoder)
    check = piece_bpe.PieceEncoder.check
    monkeypatch.setattr(piece_bpe.PieceEncoder, "check", lambda self, new: (seen.append(dict(new)), check(self, new)))
    texts = [*TEXTS, "the the", "a\n\nb»c", None]
    list(piece_bpe._encoded(iter(enumerate(texts)), PATH, True))
    new = {k: v for part in seen for k, v in part.items()}
    inner = [w for w in new if not w.startswith(encoder.prefix)]
    assert inner and all(any(w in run for run in new if run.startswith(encoder.prefix)) for w in inner)
    run = next(r for r in new if r.startswith(encoder.prefix) and any(r.endswith(w) for w in inner))
    with pytest.raises(ValueError, match="library encodes"):
        check(encoder, {run: new[run][1:]})
