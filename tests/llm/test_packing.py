import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandloom.llm import packing

from .conftest import prose

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", " ", "a", "  two  spaces \n\n\t end ", "don't we'll I'M", "<|endoftext|> x", "é🤗ﬁ\u0000z", "日本語",
         "12345 67,89", "x" * 5000, " " * 3000, prose(1, 20_000)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizers_library(spark, tokenizer):
    encode = packing.encoder(RANKS)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").toPandas()["text"]
    for text in [*(t or "" for t in TEXTS), "a<|endoftext|>b", "<|endoftext|>" * 3, " <|endoftext|> ", "<|endoftext", *table]:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert encode("a<|endoftext|>b") == [64, 50256, 65]


def test_special_tokens_as_text():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    encode = packing.encoder(RANKS, special_as_text=True)
    for text in ("a<|endoftext|>b", "a" + " " * 200_000 + "<|endoftext|>"):
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
        assert 50256 not in encode(text)


def test_other_columns_may_have_any_name(documents):
    table = documents([(1, "some text")])
    clash = table.withColumns({c: F.lit("x") for c in ("start", "length", "ids", "sequence_id", "offset", "doc_tokens")})
    assert packing.pack(clash, RANKS).collect() == packing.pack(table, RANKS).collect()


def test_very_long_white_space(documents, tokenizer):
    texts = ["a" + " " * 3_000_000 + "b<|endoftext|>", "\n" * 3_000_000]
    found = packing.pack(documents([*enumerate(texts)]), RANKS).toPandas().sort_values(["doc_id", "start"])
    for key, text in enumerate(texts):
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in found["ids"][found["doc_id"] == key]])
        assert np.array_equal(ids, [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID])


def test_pieces_are_powers_of_two_and_join_to_the_document(documents, tokenizer):
    table = documents([*enumerate(TEXTS), (3, "a"), (None, "b")])
    found = packing.pack(table, RANKS).toPandas()
    assert found["sequence_id"].is_unique and (found["offset"] == 0).all()
    sizes = found["length"].to_numpy()
    assert ((sizes & (sizes - 1)) == 0).all() and sizes.max() == packing.LONGEST and sizes.min() >= 1
    for key, text in [*enumerate(TEXTS)]:
        if key == 3:
            continue
        own = found[found["doc_id"] == key].sort_values("start")
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in own["ids"]])
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert (own["doc_tokens"] == len(ids)).all()
    assert len(found[found["doc_id"] == 3]) == 2 and found["doc_id"].isna().sum() == 1


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 4096, 10_000])
def test_binary_lengths(n):
    parts = packing.binary_lengths(n)
    assert sum(parts) == n and parts == sorted(parts, reverse=True)
    assert len([p for p in parts if p < packing.LONGEST]) == len({p for p in parts if p < packing.LONGEST})


def test_buckets_on_disk_hold_one_length(spark, documents, tmp_path):
    packed = packing.pack(documents([(i, prose(i, 50)) for i in range(9)]), RANKS)
    packing.write_buckets(packed, f"file://{tmp_path}/out")
    again = spark.read.parquet(f"file://{tmp_path}/out")
    assert again.count() == packed.count()
    assert again.filter(F.octet_length("ids") != 4 * F.col("length")).count() == 0


def test_empty_table_and_bad_length(documents):
    assert packing.pack(documents([]), RANKS).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(documents([]), RANKS, longest=1000)
