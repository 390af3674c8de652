"""Personal data: fixed patterns by plain regular expressions, discovery by loops."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from recordloom.llm import personal

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    """(kind, start, end), by the contract's own patterns."""
    text, only = text or "", lambda s: re.sub("[^0-9]", "", s)
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(only(m[0])) <= 19 and luhn(only(m[0]))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(only(m[0])) <= 15]


def discovered(texts):
    """Spans beyond the base, by the docstring's definition."""
    slots = []  # doc, kind, start, end, instance, left, around
    totals = defaultdict(int)
    for d, text in enumerate(texts):
        text = text or ""
        words = [(m.start(), m.end(), re.sub("[A-Z]", lambda x: x[0].lower(), m[0])) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        word = lambda i: words[i][2] if 0 <= i < len(words) else ""
        for i in range(len(words)):
            totals["l", word(i - 2), word(i - 1)] += 1
            totals["a", word(i - 1), word(i + 1)] += 1
        seeds = []
        for k, a, b in base(text):
            if not any(x < b and a < y for _, x, y in seeds):
                seeds.append((k, a, b))
        for k, a, b in seeds:
            n = next(i for i, w in enumerate(words) if w[0] <= a < w[1])
            last = max(i for i, w in enumerate(words) if w[0] < b)
            slots.append((d, k, a, b, text[a:b].lower(), ("l", word(n - 2), word(n - 1)), ("a", word(n - 1), word(n + 1)) if last == n else None))
        for i, (a, b, _) in enumerate(words):
            bare = text[a:b].strip(personal.EDGES)
            if any(x < b and a < y for _, x, y in seeds) or not 4 <= len(bare) <= 64 or not ("@" in bare or len(re.findall("[0-9]", bare)) >= 4):
                continue
            a = text.index(bare, a)
            slots.append((d, None, a, a + len(bare), bare.lower(), ("l", word(i - 2), word(i - 1)), ("a", word(i - 1), word(i + 1))))
    known = {}
    for _, k, _, _, name, _, _ in slots:
        if k is not None:
            known[name] = min(k, known.get(name, 9))
    start = dict(known)
    for _ in range(personal.ROUNDS):
        fill, names = defaultdict(int), defaultdict(set)
        for _, _, _, _, name, left, around in slots:
            for p in (left, around):
                if p and name in known:
                    fill[p, known[name]] += 1
                    names[p, known[name]].add(name)
        trusted = {p: (n / (totals[p] + 1), -k) for (p, k), n in fill.items() if len(names[p, k]) >= personal.INSTANCES and n / (totals[p] + 1) >= personal.TRUST}
        sums, every = defaultdict(float), defaultdict(int)
        for _, k, _, _, name, left, around in slots:
            if k is None:
                every[name] += 1
                best = max((trusted[p] for p in (left, around) if p in trusted), default=None)
                if best and (-best[1] == 0) == ("@" in name):
                    sums[name, -best[1]] += best[0]
        new = {}
        for (name, k), total in sorted(sums.items(), key=lambda x: (x[1], -x[0][1])):
            if total / every[name] >= personal.ACCEPT and name not in known:
                new[name] = k
        if not new:
            break
        known |= new
    return [(d, known[name], a, b) for d, k, a, b, name, _, _ in slots if k is None and name in known and name not in start]


def expected(texts):
    out = {i: base(t) for i, t in enumerate(texts)}
    more = defaultdict(list)
    for d, *span in discovered(texts):
        more[d].append(tuple(span))
    name = lambda spans: ",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in spans)
    return {i: (*[sum(k == j for k, _, _ in b) for j in range(4)], hashlib.sha256(name(b).encode()).hexdigest(), name(sorted(b + more[i]))) for i, b in out.items()}


def rows(df):
    return {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in df.collect()}


def table(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return df.withColumns({"row": F.lit(1), "kind": F.lit("x"), "pattern": F.lit(0), "n": F.lit(2)})


def contexts(rng):
    """Prose, telling contexts with seeds and identifiers that no fixed pattern knows, and chains of contexts."""
    prose = lambda: " ".join(rng.choices("the of and thing one er in to".split(), k=rng.randint(2, 15)))
    mail = lambda: f"{rng.choice(['ann', 'bo', 'cy'])}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"
    phone = lambda: f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
    texts = [f"{prose()} write mail to: {mail()} {prose()}" for _ in range(120)]
    texts += [f"{prose()} call us at {phone()}, {prose()}" for _ in range(30)]
    texts += [f"{prose()} write mail to: admin{i}@intranet {prose()}" for i in range(8)] * 2
    texts += [f"{prose()} Call us at (0{i}) 555-77{i}{i} {prose()}" for i in range(4)]
    texts += [f"{prose()} desk box of admin{i}@intranet now" for i in range(8)] + [f"{prose()} desk box of root@cluster now"]
    texts += [f"{prose()} {mail()} {prose()} {rng.randint(1000, 99999)} {prose()}" for _ in range(30)]
    return texts


ODD = ["", None, " \n", "a@b.c_x@d.ef a@b@c.de @x.y x@ x@y x@y. x@y..z %@a-.b", "1.2.3.4.5 256.1.1.1 01.02.03.004 1..2.3.4 9.9.9.9.9.9.9.9", "4111 1111 1111 1111 4111-1111-1111-1112 " + "4" * 40 + " 4 4 4 4", "+1+2 555 (+44) 20-7946-0958) +1 ((((( +123456789012345678", "é 🎉 ann@example.org é", "A@B.CO:+1 (743) 555-3824,1.1.1.1 x", "\x1c1\x85 12@34"]


def test_fixed_patterns():
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices("a.@-1 +(%é2", k=rng.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choices("0123456789 -.+", k=rng.randint(10, 80))) for _ in range(3000)]
    assert [personal.base_spans(t or "") for t in texts] == [base(t) for t in texts]


def test_fixed_patterns_are_linear():
    for text in ["a" * 400_000, "1" * 400_000, "a@" * 200_000, "1." * 200_000, "+1 " * 130_000, "- " * 200_000, "1 " * 200_000]:
        personal.base_spans(text)  # quadratic ways would take hours


def test_discovery_by_loops(spark):
    texts = contexts(random.Random(9)) + ODD
    want = expected(texts)
    assert rows(personal.query(table(spark, texts))) == want
    found = [s for *_, s in want.values() if s]
    assert sum("email" in s for s in found) > 60  # seeds, @intranet names in both contexts
    cluster = next(i for i, t in enumerate(texts) if t and "root@cluster" in t)
    assert "email" in want[cluster][-1]  # its context is trusted only from what the first round found


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = docs.orderBy("doc_id").collect()
    want = dict(zip([r.doc_id for r in own], expected([r.text for r in own]).values()))
    assert rows(personal.query(docs)) == want


def test_occurrences_with_a_full_bitmap(spark):
    """Few bits let pairs through that are no patterns; the join takes them out."""
    docs = table(spark, ["a b c", "a b d", "b a b c"])
    seen = personal.found(docs.select("row", "doc_id", "text"))
    assert seen.count() == 3
    h = lambda w: personal.np.array([personal.xxhash.xxh3_64_intdigest(w.encode())], personal.np.uint64)
    keys = [int(personal.pair_keys(h("a"), h("b"), 0)[0]), int(personal.pair_keys(h("b"), h(""), 1)[0])]
    patterns = spark.createDataFrame([(k,) for k in keys], "pattern long")
    assert {r.pattern: r.total for r in personal.occurrences(docs, patterns, 32).collect()} == {keys[0]: 3, keys[1]: 3}


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "x@y.zz"), (1, "x@y.zz"), (None, "x@y.zz"), (None, None)], "doc_id long, text string")
    assert sorted(r.spans for r in personal.query(df).collect()) == ["", "email:0:6", "email:0:6", "email:0:6"]
    assert personal.query(df.limit(0)).count() == 0
