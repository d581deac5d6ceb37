from __future__ import annotations

import base64
import random

import pytest

from marani.llm import encode

FILES = ["/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/byte_bpe_50k.tiktoken", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"]


def reference(path):
    tiktoken = pytest.importorskip("tiktoken")
    path = path.replace(".json", ".tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=encode.SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("path", FILES)
def test_transducer(path):
    ref, merges = reference(path), encode.load_merges(path)
    t, rng = encode.Transducer(merges), random.Random(1)
    for n in range(4000):
        if n % 4 == 0:
            data = bytes(rng.randrange(256) for _ in range(rng.randint(1, 20)))
        elif n % 4 == 1:
            data = (rng.choice(["a", "ab", "=", "-", "ა", "aab", " ", "სა"]) * rng.randint(1, 60)).encode()
        elif n % 4 == 2:
            data = b"".join(rng.choice(merges.tokens) for _ in range(rng.randint(1, 6)))
        else:
            data = "".join(rng.choice("the აბგდევზ ing 0123 ქართული é😀") for _ in range(rng.randint(1, 30))).encode()
        assert t.encode(data) == ref._encode_single_piece(data), data


def test_table(spark):
    ref = reference(FILES[0])
    texts = ["მზე ანათებს. It's 5 o'clock\n\n  <|endoftext|>!", "", None, "x" * 30_000, "ა" * 20_000, " \t\n ", "e­​́👩‍👧 ①ﬁ", "მზე"]
    rows = [(n, t, "c") for n, t in enumerate(texts)] + [(0, texts[0], "c"), (None, "ab", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode.encode_texts(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: list(r["ids"]) for r in got}
    assert all(by[n] == (ref.encode_ordinary(t) if t else []) for n, t in enumerate(texts))
    assert by[None] == ref.encode_ordinary("ab")
    back = encode.decode_ids(encode.encode_texts(df).withColumnRenamed("ids", "tokens"), "tokens").collect()
    assert {r["doc_id"]: r["text"] for r in back} == {n: t or "" for n, t in enumerate(texts)} | {None: "ab"}
    assert encode.encode_texts(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        encode.encode_texts(df, keep=["ids"])


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(encode, "MEMO_LIMIT", 50)
    ref, pieces, rng = reference(FILES[0]), encode.PieceIds(encode.load_merges()), random.Random(2)
    for _ in range(500):
        w = "".join(rng.choice("აბგდabc") for _ in range(rng.randint(1, 9)))
        assert list(memoryview(pieces[w]).cast("i")) == ref.encode_ordinary(w)
        assert len(pieces) <= 52


def test_streaming_decode():
    m = encode.load_merges()
    by_id = dict(zip(m.ids, m.tokens))
    data = "ა😀é".encode()
    single = {t: i for i, t in by_id.items()}
    d = encode.StreamDecoder(by_id)
    parts = [d.feed([single[bytes([b])]]) for b in data]
    assert "".join(parts) == "ა😀é" and parts[0] == parts[1] == "" and d.close() == ""
    assert encode.StreamDecoder(by_id).feed([single[b"\xe1"]]) == ""
