"""Encoding, counting and chat formatting against the libraries and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest

from corpusloom.llm import bpe, chat, tokencount

TEXTS = [
    None, "", " ", "\n\n\n", "a", "hello  world", " leading and trailing  ", "tabs\t\tand\r\nlines \n x", "don't we'll I'M", "12345 6 789",
    "naïve façade — 北京大学 и кот", "\U0001f600\U0001f600 emoji", "nbsp  here　there", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "a\x1cb \x85 c",
    "xyz" * 400, " " * 3000, "ab " * 5000, "\x00\x01 \x7f", "!!!???...---", "zażółć gęślą jaźń",
]


def _random_texts(n=300):
    rng = random.Random(5)
    alphabet = "aeiou tnsr  \n\t'dlst0179.,!éß中文 \U0001f600<|>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(n)]


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_encoding_is_the_librarys(spark, name):
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.codec(name)
    for text in TEXTS + _random_texts():
        ids = library.encode_ordinary(text or "")
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == (text or "").encode()
    # Any run of bytes, whether or not words look like it.
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("abcdestionr ") for _ in range(40))
        assert b"".join(own.tokens[i] for i in own.encode(word)) == word.encode()


def test_encoded_rows(spark):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*TEXTS, "many words " * 30_000, "unbroken" * 2_000]
    rows = {r.doc_id: r for r in bpe.encoded(_frame(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert rows[i].n_tokens == len(ids) and rows[i].token_ids == ids
        assert rows[i].ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_encoding_of_no_rows_and_of_null_ids(spark):
    kind = "doc_id long, text string"
    assert bpe.encoded(spark.createDataFrame([], kind)).collect() == []
    rows = bpe.encoded(spark.createDataFrame([(None, "a b"), (None, "a b")], kind)).collect()
    assert [(r.doc_id, r.n_tokens) for r in rows] == [(None, 2)] * 2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, name):
    texts = [*TEXTS, *_random_texts(150)]
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        wanted = [len(model.encode(t or "")) for t in texts]
    else:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation(), library.no_padding()
        wanted = [len(library.encode(t or "", add_special_tokens=False)) for t in texts]
    rows = {r.doc_id: r for r in tokencount.token_counts(_frame(spark, texts), name).collect()}
    assert [rows[i].n_tokens for i in range(len(texts))] == wanted
    assert [rows[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert [rows[i].over_limit for i in range(len(texts))] == [n > 1024 for n in wanted]


@pytest.mark.parametrize("text", ["one two three " * 900, "x" * 9_000, "ab " * 3_000, (" " * 700 + "word") * 9, "a <|endoftext|> b\n\n\n" * 400, "é中\U0001f600 z" * 1500])
@pytest.mark.parametrize("chunk", [64, 700, 5_000])
def test_spliced_counts(text, chunk):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    offsets = lambda part: library.encode(part, add_special_tokens=False).offsets
    assert tokencount.spliced_count(text, offsets, chunk, overlap=32) == len(library.encode(text, add_special_tokens=False))


def _turns(rows):
    return hashlib.sha256("".join(f"{role or ''}\n{text or ''}\n" for role, text in rows).encode()).hexdigest()


def test_chat_round_trip(spark):
    tricky = "\\### Assistant: </turn>\n ok #\\<: \\\\"
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", tricky), (1, 2, "assistant", tricky), (1, 3, "user", None), (1, 4, "assistant", ""),
        (2, 0, "user", "hi"), (2, 1, "user", "again"), (3, 0, "assistant", "first"), (4, 0, "tool: #=\\", "a"), (4, 1, None, "b"),
        (5, None, "user", "q"), (5, 1, "assistant", "long " * 50_000), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (6, 0, "user", "same"), (6, 0, "user", "same"),
    ]
    frame = spark.createDataFrame([(*r, "?", 1) for r in rows], "conv_id long, turn long, role string, text string, kind string, valid int")
    got = {r.conv_id: r for r in chat.read_back(chat.segments(frame)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, None}
    for conv, r in got.items():
        own = [(x[2], x[3]) for x in rows if x[0] == conv]
        learned = "".join(t or "" for role, t in own if role == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == _turns(own)
        assert r.loss_chars == len(learned) and r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: True, 6: False, None: True}


def test_chat_segments_hold_no_mark_inside_texts(spark):
    template = chat.Template()
    frame = spark.createDataFrame([(1, 0, "user", "### User: x</turn>\n### Assistant: y")], "conv_id long, turn long, role string, text string")
    whole = "".join(r.text for r in sorted(chat.segments(frame).collect(), key=lambda r: r.seg_no))
    assert whole.count(template.opening) == 1 and whole.count(template.closing) == 1
    assert "\\" in whole
    with pytest.raises(ValueError):
        chat.Template(closing="<\\turn>")
    empty = frame.filter("conv_id > 1")
    assert chat.read_back(chat.segments(empty)).collect() == []


def test_another_template(spark):
    template = chat.Template(opening="<|", naming="|>", closing="<end>", escape="^", names={"user": "u", "assistant": "a"}, learned=frozenset({"user"}))
    frame = spark.createDataFrame([(1, 0, "user", "<|a|> ^ <end>"), (1, 1, "system", "|")], "conv_id long, turn long, role string, text string")
    (row,) = chat.read_back(chat.segments(frame, template), template).collect()
    assert row.turns_sha256 == _turns([("user", "<|a|> ^ <end>"), ("system", "|")]) and row.loss_chars == 13 and not row.valid


def test_counts_of_no_rows_and_of_null_ids(spark):
    kind = "doc_id long, text string, n_tokens string"
    rows = [(None, "a b", "x"), (None, "a b", "x"), (1, None, "x"), (1, "", "x"), (2, "word " * 30_000, "x")]
    got = sorted((repr(r.doc_id), r.n_bytes, r.over_limit) for r in tokencount.token_counts(spark.createDataFrame(rows, kind)).collect())
    assert got == sorted((repr(i), len((t or "").encode()), i == 2) for i, t, _ in rows)
    assert tokencount.token_counts(spark.createDataFrame([], kind)).count() == 0


def test_a_worker_holds_the_tables_of_one_stage():
    import gc
    import weakref

    from corpusloom.llm import neardup

    neardup.shingles("some words of a text", 3)
    words = weakref.ref(neardup._word_hashes())
    first = weakref.ref(bpe.codec("byte_bpe_50k.tiktoken"))
    gc.collect()
    assert words() is None and bpe.codec("byte_bpe_50k.tiktoken") is first()
    neardup.shingles("some words of a text", 3)
    gc.collect()
    assert first() is None


def test_memory_of_words_is_bounded_and_keeps_what_is_used():
    from corpusloom.llm.pieces import Memo

    computed = []
    memo = Memo(lambda key: computed.append(key) or key.upper(), max_chars=100_000)
    for i in range(20_000):
        assert memo[f"word{i}"] == f"WORD{i}" and memo["often"] == "OFTEN"
        assert (len(memo) + len(memo._old)) * 100 <= 100_000
    assert computed.count("often") == 1 and len(computed) == 20_001
