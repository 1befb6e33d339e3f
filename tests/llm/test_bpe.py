"""BPE automaton against the tokenizers library."""

import random

import pytest

from devicelife.llm.bpe_automaton import Automaton, Encoder, encode_documents

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def samples():
    rng = random.Random(1)
    alphabet = list("abcdstrevml'  \n\t\r!?.0123éÀßñ中文字😀́ \x85\x1c\x00") + [
        "<|endoftext|>", "'s", "'re", "'ll", " '", "  ", "Ᲊ", "࢏", chr(0x10FFFF), "the", " and"]
    out = ["", "'s", "don't 's 'll'll ''s", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 3000, " " * 2000,
           "!" * 2000 + "x", "ab" * 3000, "\n" * 500 + "a", "thethethe" * 500]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]


def test_encode_and_decode_as_the_library(library):
    texts = samples()
    enc = Encoder.of(PATH)
    for text, words in zip(texts, enc.encode(texts), strict=True):
        ids = [int(i) for w in words for i in w[1].split(b",") if i]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, repr(text)
        assert enc.automaton.decode(ids) == library.decode(want, skip_special_tokens=False)


def plain_bpe(word, ranks):
    """Textbook merging: always the lowest ranked pair, leftmost first."""
    parts = list(word)
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
        if best is None:
            return parts
        i = best[1]
        parts[i:i + 2] = ["".join(parts[i:i + 2])]


def test_gadgets_on_random_merges():
    rng = random.Random(5)
    for _ in range(150):
        tokens, merges = list("abc"), []
        for _ in range(rng.randint(0, 14)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens and len(u + v) < 9:
                tokens.append(u + v)
                merges.append((u, v))
        machine = Automaton({t: i for i, t in enumerate(tokens)}, merges)
        ranks = {m: r for r, m in enumerate(merges)}
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
            want = [tokens.index(t) for t in plain_bpe(word, ranks)]
            assert machine.encode_word(word.encode()) == want
            assert machine.encode_words([word.encode()]) == [want]


def test_documents(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello world's", "x"), (3, "Hello world's", "x"), (None, "z" * 100_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = encode_documents(df, PATH, with_ids=True).collect()
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) and r.n_tokens == len(r.ids) for r in got)
    assert encode_documents(df.limit(0), PATH).count() == 0
