import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as E
from odd_rows import SF_SMALL, no_docs, odd_docs  # noqa: F401
from panelkit.llm import bpe_codec, packing, token_counts

BITS = ["a", "e", "t", "h", "the", "in", "ing", " ", "  ", "\n", "\t", "▁", "é", "漢", "字", "😀", "=", "--", "　", "\x00", "<s>", "1", "23", "'s", "и", "<|endoftext|>", "\x1c", "\x85", "<0x41>"]
TEXTS = ["", " ", "  ", "a" * 300, "=-" * 200, " " * 500, " foo", "foo ", "foo  ", " " * 50 + "t" + " " * 37, "abc " * 1000 + "  ", "x" * 40 + "yz" * 300]
_rnd = random.Random(2)
TEXTS += ["".join(_rnd.choice(BITS) for _ in range(_rnd.randint(1, 60))) for _ in range(800)]


def test_counts_match_the_library():
    model = open(P.path("piece_bpe_32k.model"), "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert token_counts.TokenCounter(model).count(TEXTS) == [len(x) for x in library.encode(TEXTS)]


def test_count_query(spark, odd_docs, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = E.queries()["op2_token_counts"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {i: (len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in docs.items()}
    odd = token_counts.count_tokens(odd_docs, P.path("piece_bpe_32k.model"), limit=5).collect()
    assert len(odd) == odd_docs.count()
    assert {(r.n_bytes, r.n_tokens, r.over_limit) for r in odd if r.doc_id in (3, 4)} == {(0, 0, False)}
    assert token_counts.count_tokens(no_docs, P.path("piece_bpe_32k.model")).collect() == []


@pytest.mark.parametrize("kind", ["letters", "cjk", "mixed", "one letter", "one sign", "white", "spaces", "words"])
def test_counts_of_long_units(kind):
    """In time that grows with the length, whatever the unit is made of."""
    model = open(P.path("piece_bpe_32k.model"), "rb").read()
    text = {"spaces": " " * 100_000 + "x" + " " * 33, "words": "thequickbrownfoxjumps" * 4_000}.get(kind) or LONG_RUNS[kind]
    counter = token_counts.TokenCounter(model)
    start = time.process_time()
    (count,) = counter.count([text])
    assert time.process_time() - start < 20
    assert count == len(sentencepiece.SentencePieceProcessor(model_proto=model).encode(text))


def test_counts_of_drawn_pieces():
    """Texts glued together from the model's own pieces, where ties and cuts between parts meet."""
    model = open(P.path("piece_bpe_32k.model"), "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    rnd = random.Random(11)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(300, library.get_piece_size())]
    texts = ["".join(rnd.choice(pieces) + " " * rnd.choice([0, 0, 0, 1, 2, 5, 17, 40]) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    assert token_counts.TokenCounter(model).count(texts) == [len(x) for x in library.encode(texts)]


@pytest.fixture(scope="module")
def ranks():
    return bpe_codec.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


def test_codec_matches_the_library(ranks):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe_codec.DuckCodec(ranks, P.PATTERN)
    ids, begins = codec.encode(pa.array(TEXTS))
    encoded = [ids[a:b].astype("<u4").tobytes() for a, b in zip(begins, begins[1:])]
    assert encoded == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in TEXTS]
    assert [b.decode() for b in codec.decode(encoded)] == TEXTS
    with pytest.raises(ValueError):
        codec.decode([np.array([60_000], "<u4").tobytes()])


LONG_RUNS = {
    "letters": "".join(_rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)),
    "cjk": "".join(chr(_rnd.randint(0x4E00, 0x9FFF)) for _ in range(33_000)),
    "mixed": "".join(_rnd.choice(["a", "the", "é", "漢", "字", "😀", "и", "-", "1"]) * _rnd.randint(1, 9) for _ in range(20_000)),
    "one letter": "x" * 100_000,
    "one sign": "漢" * 20_000 + "=" * 30_000,
    "white": " " * 5_000 + "\n" * 3_000,
}


@pytest.mark.parametrize("kind", sorted(LONG_RUNS))
def test_long_runs_without_a_space(ranks, kind):
    """One method for all lengths, in time that grows with the length."""
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe_codec.DuckCodec(ranks, P.PATTERN)
    start = time.process_time()
    ids, _ = codec.encode(pa.array([LONG_RUNS[kind]]))
    assert time.process_time() - start < 60
    assert ids.tolist() == library.encode_ordinary(LONG_RUNS[kind])


def test_windows_share_tokens_or_grow(ranks, monkeypatch):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe_codec, "WINDOW", 8)
    monkeypatch.setattr(bpe_codec, "BATCH_ROWS", 500)
    ids, begins = bpe_codec.DuckCodec(ranks, P.PATTERN).encode(pa.array(TEXTS))
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [library.encode_ordinary(t) for t in TEXTS]


def test_cache_drops_what_is_old_and_stays_right(ranks, monkeypatch):
    monkeypatch.setattr(bpe_codec, "CACHE_BYTES", 3000)
    monkeypatch.setattr(packing, "CACHE_BYTES", 3000)
    path = P.path("byte_bpe_50k.json")
    pairs = [
        (bpe_codec.DuckCodec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary),
        (packing.CachedEncoder(open(path, "rb").read()), lambda t: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids),
    ]
    words = [f"w{i} the, and. é{i}" for i in range(60)]
    texts = [" ".join(_rnd.choice(words) for _ in range(40)) for _ in range(12)]
    for own, encode in pairs:
        for at in range(0, 12, 2):
            ids, begins = own.encode(pa.array(texts[at : at + 2]))
            assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [encode(t) for t in texts[at : at + 2]]
            own.cache.trim()
            assert own.cache.size <= 3000 or len(own.cache.words) < 200


def test_unknown_ids_are_refused(ranks):
    gap = {k: v if v < 50_000 else v + 10 for k, v in ranks.items()}
    with pytest.raises(ValueError, match="50005"):
        bpe_codec.DuckCodec(gap, P.PATTERN).decode([np.array([1, 50_005], "<u4").tobytes()])


def test_recursive_query_has_a_row_a_contraction(ranks, monkeypatch):
    """Not one for every token of every step; first, last and only pairs contract as in the library."""
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe_codec.DuckCodec(ranks, P.PATTERN)
    rnd = random.Random(8)
    pieces = [b"a", b"in", b"ing", b"\xff\xfe", " 漢字".encode(), b"x" * 90]
    pieces += [bytes(rnd.choice(b"abcdefghinorst") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    expected = [library._encode_single_piece(p) for p in pieces]
    ids, sizes = codec._contract(pieces)
    assert ids.tolist() == [i for e in expected for i in e] and sizes.tolist() == [len(e) for e in expected]
    monkeypatch.setattr(bpe_codec, "_ENCODE", bpe_codec._ENCODE.rpartition("SELECT")[0] + "SELECT [count(*)::INTEGER] AS ids FROM state")
    assert codec._contract(pieces)[0].tolist() == [sum(1 + len(p) - len(e) for p, e in zip(pieces, expected))]


def test_codec_query(spark, odd_docs, no_docs, ranks):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    expected = {}
    for i, t in docs.items():
        ids = library.encode_ordinary(t)
        expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    rows = E.queries()["op6_bpe_codec"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == expected
    path = P.path("byte_bpe_multi_50k.tiktoken")
    odd = bpe_codec.decode_documents(bpe_codec.encode_documents(odd_docs, path, P.PATTERN), path).collect()
    assert sorted(bytes(r.decoded).decode() for r in odd) == sorted(r.text or "" for r in odd_docs.collect())
    assert bpe_codec.encode_documents(no_docs, path, P.PATTERN).collect() == []


def test_packing_encoder_matches_the_library():
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    own = packing.CachedEncoder(open(path, "rb").read())
    ids, begins = own.encode(pa.array(TEXTS))
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [e.ids for e in library.encode_batch(TEXTS, add_special_tokens=False)]


def test_windows_are_optimal():
    rnd = random.Random(3)
    for _ in range(300):
        length = rnd.randint(5, 30)
        points, at = [], 0
        for _ in range(rnd.randint(1, 25)):
            at += rnd.randint(1, length)
            points.append(at)
        penalties = [rnd.choice([0, 2, 7]) for _ in points]
        best = {-1: 0}
        for j in range(len(points)):
            best[j] = min(best[i] + length - (points[j] - (points[i] if i >= 0 else 0)) + penalties[j] for i in range(-1, j) if points[j] - (points[i] if i >= 0 else 0) <= length)
        cuts = packing.best_windows(points, penalties, length)
        edges = [0, *[points[c] for c in cuts]]
        assert cuts[-1] == len(points) - 1 and all(0 < b - a <= length for a, b in zip(edges, edges[1:]))
        assert sum(length - (b - a) for a, b in zip(edges, edges[1:])) + sum(penalties[c] for c in cuts) == best[len(points) - 1]


def check_pieces(rows, texts, tokenizer, length):
    """Every id in exactly one piece, gapless sequences of at most ``length``, right checksums."""
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids.keys()
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[i])
            assert p.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids[i])
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
    return 1 - sum(r.length for r in rows) / (length * len(by_sequence))


def test_packing_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = E.queries()["op4_packing"](spark, SF_SMALL).collect()
    assert check_pieces(rows, texts, Tokenizer.from_file(P.path("byte_bpe_50k.json")), 2048) < 0.04


def test_packing_odd_rows(spark, odd_docs, no_docs):
    path = P.path("byte_bpe_50k.json")
    unique = odd_docs.dropDuplicates(["doc_id", "text"]).coalesce(2)
    for block in (1, 1 << 20):
        rows = packing.pack_documents(unique, path, length=256, block=block).collect()
        check_pieces(rows, {r.doc_id: r.text or "" for r in unique.collect()}, Tokenizer.from_file(path), 256)
    assert sum(r.start == 0 for r in packing.pack_documents(odd_docs, path).collect()) == odd_docs.count()
    assert packing.pack_documents(no_docs, path).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(odd_docs, path, length=8)
