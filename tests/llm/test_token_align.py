"""Token alignment against whole texts encoded at once."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordloom.llm import token_align
from recordloom.llm.token_align import Fragment, compose

TEXTS = [
    "", None, " ", "  ", "a", "x ", " x", "x  y", "don't stop  <|endoftext|> <s> now ", "line one\n line two\n\n  three\t four", "with ▁ inside",
    "é ñ 日本 語 🎉 🎉🎉", "\x00\x07 \x1c x\x1c y \x85 z　 w  v", "nospace" * 40, "a b c d e f g h i j k l m n o p", "  lead and trail   ", "\n", " \n ", "x\n", "éé" * 30 + " é",
]


def expected(texts):
    """doc -> (n_a, n_b, groups, links), by loops over whole encodings."""
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    out = []
    for text in texts:
        if not text:
            out.append((0, 0, "", []))
            continue
        a = a_tok.encode(" " + text, add_special_tokens=False).ids
        b = b_tok.encode(text)
        a_bytes = [bytes(letter[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_tok.id_to_piece(i)) for i in b)]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            out.append((0, 0, "", []))
            continue
        ends = lambda parts: [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
        a_ends, b_ends = ends(a_bytes), ends(b_bytes)
        both = sorted(set(a_ends) & set(b_ends))
        groups = [",".join(str(i) for i, e in zip(a, a_ends) if lo < e <= hi) + "|" + ",".join(str(i) for i, e in zip(b, b_ends) if lo < e <= hi) for lo, hi in zip([0, *both], both)]
        links = [(i, j) for i, e in zip(a, a_ends) for j, f in zip(b, b_ends) if e == f]
        out.append((len(a), len(b), ";".join(groups), links))
    return out


def digest(texts):
    found = expected(texts)
    counts = Counter(k for _, _, _, links in found for k in links)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (na, nb, g.count(";") + 1 if g else 0, len(links), sum(counts[k] == top[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for na, nb, g, links in found
    ]


def rows(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r.doc_id: tuple(r[n] for n in names) for r in df.collect()}


def table(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return df.withColumns({"row": F.lit(1), "link": F.lit("x"), "index": F.lit(0), "n": F.lit(2)})


@pytest.mark.parametrize("size, fan", [(1 << 16, 16), (7, 2), (40, 3)])
def test_equals_whole_encoding(spark, monkeypatch, size, fan):
    """Short and long way, any width of ranges and tree."""
    monkeypatch.setattr(token_align, "CHUNK", size)
    monkeypatch.setattr(token_align, "FAN", fan)
    monkeypatch.setattr(token_align.align, "__defaults__", (size, *token_align.align.__defaults__[1:]))
    rng = random.Random(size)
    words = ["the", "the", "of", "Straße", "naïve", "don't", "3.14", "\n", "", "日本語", "x\ty", "ünd", ",", "🎉", "AKIA99", "<s>"]
    texts = TEXTS + [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(40)]
    assert rows(token_align.query(table(spark, texts))) == dict(enumerate(digest(texts)))


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = docs.select("doc_id", "text").collect()
    assert rows(token_align.query(docs)) == dict(zip([r.doc_id for r in own], digest([r.text for r in own])))


def test_compose_is_associative():
    """Fragments of any cutting, in any grouping, close the same stretches."""
    rng = random.Random(5)

    def fold(parts):
        """Random binary tree; closed texts in order."""
        if len(parts) == 1:
            return parts[0]
        k = rng.randrange(1, len(parts))
        (left, before), (right, behind) = fold(parts[:k]), fold(parts[k:])
        out, text = compose(left, right)
        return out, before + ([text] if text is not None else []) + behind

    for _ in range(300):
        text = "".join(rng.choices("ab \né", k=rng.randint(1, 40)))
        places = sorted(rng.sample(range(len(text) + 1), min(5, len(text))))
        parts = [text[a:b] for a, b in zip([0, *places], [*places, len(text)])]
        whole, closed = fold([(f, [c] if c is not None else []) for f, c in (compose(Fragment(p), Fragment()) for p in parts)])
        flat = [x for t in ([whole.head] if whole.closed else []) + closed + ([whole.tail[1:]] if whole.closed else [whole.head]) for x in token_align.CUT.split(t)]
        assert flat == token_align.CUT.split(text)
        assert compose(Fragment(), Fragment(text))[0] == compose(Fragment(text), Fragment())[0]


def test_odd_rows(spark):
    """Repeated rows, null ids, an empty table."""
    df = spark.createDataFrame([(1, "same text here"), (1, "same text here"), (None, "same text here"), (None, None)], "doc_id long, text string")
    out = token_align.query(df).collect()
    assert len(out) == 4 and len({r.groups_sha256 for r in out}) == 2
    assert sorted(r.count_sum for r in out) == [0] + [3 * out[0].n_links if out[0].n_links else 9] * 3
    assert token_align.query(df.limit(0)).count() == 0
