"""Tokenizer-based operators against the tokenizers library, and their defined cases."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from occurra.llm import bpe, chat, packing, queries
from occurra.llm.tokens import byte_bpe, default_path

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "Hello WORLD's 12 été\n\n  naïve  "), (2, None), (3, ""), (4, "x" * 5000), (None, "no id"), (1, "again"),
    (1, "again"), (5, "日本語 İstanbul ǅ ½ ١٢ ́é"), (6, "<|endoftext|> <|startoftext|>a<|endoftext|>"), (7, " \t\r\n"),
    (8, "word " * 9000), (9, "\x1c\x85  ¼²ªº"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'q' as ids", "1 as sequence_id", "2 as start"
    )


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_byte_ids_are_the_library_s(text):
    lib = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    own = byte_bpe(default_path("byte_bpe_50k.json"))
    assert own.ids(text).tolist() == lib.encode(text, add_special_tokens=False).ids
    assert own.decode(own.ids(text, specials=False).tolist()).decode() == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80), st.booleans())
def test_word_ids_are_the_library_s(text, latin):
    if latin:
        text = "".join(chr(ord(c) % 0x250) for c in text)
    path = default_path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    (ids,) = bpe.Encoder(path, None).encode([text])
    want = lib.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert bpe.word_bpe(path).decode(ids).decode() == lib.decode(want, skip_special_tokens=False)


def test_transducer_finds_its_words_and_no_other(tmp_path):
    rng = np.random.default_rng(3)
    words = {bytes(rng.integers(97, 101, rng.integers(1, 9)).astype(np.uint8)) for _ in range(700)}
    ids = {w: np.array([len(w), *w[:2]], "<u4").tobytes() for w in words}
    arrays = bpe.compile_words(ids)
    bpe.Lexicon.write(arrays, str(tmp_path / "lex"))
    lex = bpe.Lexicon(str(tmp_path / "lex"))
    other = [w + b"zz" for w in words] + [w[:-1] for w in words] + [b"", b"q" * 60]
    asked = [*words, *other]
    assert lex.find(asked) == [ids.get(w) for w in asked]
    assert len(arrays["final"]) < sum(map(len, words)) / 2  # states are shared
    bpe.Lexicon.write(bpe.compile_words({}), str(tmp_path / "none"))
    assert bpe.Lexicon(str(tmp_path / "none")).find([b"a"]) == [None]


def test_encode_and_decode_defined_cases(spark, odd):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted(map(tuple, bpe.decode(bpe.encode(odd, words=5)).collect()), key=str)
    want = []
    for doc_id, text in ODD:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, bytearray(np.array(ids, "<u4").tobytes()), lib.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    assert bpe.encode(odd.limit(0)).count() == 0


def test_op10_matches_the_library(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    rows = queries.op10_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def check_packing(rows, want, tokens, segments, loss):
    """Every id in one piece, no gaps, all limits kept; returns the padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc_id, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == np.array(want[doc_id], "<u4").tobytes()
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert {r.doc_tokens for r in pieces} == {len(want[doc_id])}
    pad = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        used = sum(r.length for r in pieces)
        assert used <= tokens and len(pieces) <= segments and sum(r.loss for r in pieces) <= loss
        pad += 0 if used & (used - 1) == 0 else tokens - used
    return pad


@pytest.mark.parametrize("tokens,segments,loss,pool", [(2048, 128, None, 512), (64, 3, None, 8), (64, 4, 20, 8), (7, 1, 1, 1)])
def test_packing_keeps_every_limit(spark, odd, tokens, segments, loss, pool):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = odd.where("doc_id is not null and doc_id <> 1")
    want = {i: lib.encode(t or "", add_special_tokens=False).ids + [1] for i, t in ODD if i not in (None, 1)}
    rows = packing.pack(docs, tokens=tokens, segments=segments, loss=loss, pool=pool).collect()
    assert set(r.doc_id for r in rows) == set(want)
    assert check_packing(rows, want, tokens, segments, loss or tokens) == 0


def test_packing_prompts_bear_no_loss(spark):
    items = spark.createDataFrame(
        [(i, "question " * (i % 40), "answer " * (i % 7)) for i in range(300)], "doc_id long, prompt string, text string"
    )
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = lambda t: lib.encode(t, add_special_tokens=False).ids
    want = {i: ids("question " * (i % 40)) + ids("answer " * (i % 7)) + [1] for i in range(300)}
    rows = packing.pack(items, tokens=128, segments=6, loss=24, pool=32, prompt="prompt").collect()
    assert check_packing(rows, want, 128, 6, 24) == 0
    assert sum(r.loss for r in rows) == sum(len(ids("answer " * (i % 7))) + 1 for i in range(300))


def test_packing_other_cases(spark, odd):
    rows = packing.pack(odd.where("doc_id is null or doc_id = 1")).collect()
    assert sum(r.start == 0 and r.doc_id == 1 for r in rows) == 3 and any(r.doc_id is None for r in rows)
    assert packing.pack(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, segments=0)


@given(st.text(alphabet="<|\\ima_n>x\n", max_size=30))
def test_escapes_are_undone(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "<|" not in chat.escape(text) and "\n" not in chat.escape_role(text)


def digests(turns):
    said = "".join(t or "" for _, r, t in turns if r == "assistant")
    line = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(line), len(said), sha(said)


def test_chat_round_trip_and_defined_cases(spark):
    turns = [
        (1, 0, "user", "hi <|im_end|> <\\| \\"), (1, 1, "assistant", "日本 <|im_start|>é"), (1, 2, "assistant", None),
        (2, 0, None, ""), (2, 1, "we\nird\\role<|", "x"), (None, 0, "user", "nobody"), (3, 1, "assistant", "b " * 70_000),
        (3, None, "assistant", "first"), (4, 0, "user", "same"), (4, 0, "user", "same"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' as ids", "0 as position"
    )
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_chat(df)).collect()}
    by = {}
    for c, t, r, x in sorted(turns, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1])):
        by.setdefault(c, []).append((t, r, x))
    assert got == {c: digests(t) for c, t in by.items()}
    assert chat.read_back(chat.format_chat(df.limit(0))).count() == 0


def test_chat_marks_are_only_spliced(spark):
    rows = chat.format_chat(
        spark.createDataFrame([(1, 0, "assistant", queries.CONTROL)], "conv_id long, turn long, role string, text string")
    ).collect()
    own = byte_bpe(default_path("byte_bpe_50k.json"))
    ids = np.frombuffer(rows[0].ids, "<u4")
    assert (ids >= own.size).sum() == 2 and len(rows[0].mask) == len(ids)


def test_op1_matches_plain_python(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-1, 0, "user", queries.CONTROL), (-1, 1, "assistant", queries.CONTROL)]
    by = {}
    for c, t, r, x in sorted(turns, key=lambda r: r[:2]):
        by.setdefault(c, []).append((t, r, x))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.op1_chat(spark, SF).collect()}
    assert got == {c: digests(t) for c, t in by.items()}
    assert re.fullmatch("[0-9a-f]{64}", got[-1][1])
