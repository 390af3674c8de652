"""Secret scans: fixed patterns plus a randomness test battery, in DataFrame functions only.

Fixed kinds are ``assign`` (keyword, separator, value of 12+ characters), ``access`` (access key
ids) and ``hex`` (16+ hex digits). The battery adds kind ``random``: every run of 20+ base64-like
characters that mixes letters with digits is given the encoding it fits (hex, base32, base36,
base62, base64) and tested against a uniform draw from that alphabet:

* chi-squared of the symbol counts (upper tail),
* Wald-Wolfowitz runs of symbols in the upper and lower half of the alphabet (two-sided),
* lag-1 serial correlation of the symbol values (two-sided).

Fisher's method joins the three into one score, near 1 for what looks drawn at random. How high
natural strings score is measured, by length band, on decoys: every candidate of the corpus gives
``DECOYS`` strings of its own length, cases and digit places whose letters are running letters of its
document's other text. A candidate's p-value is the share of its band's decoys that score as high,
and a Benjamini-Hochberg pass within each band reports candidates so that at most a share ``fdr`` of
them is expected to be natural. Bands keep the many short strings, on which the tests are weak, from
setting the threshold of the long ones. Scores enter as bins of a fixed grid, so that the pass needs
only a (band x bin) count table, whose size doesn't depend on the corpus. A band without decoys
(texts without other letters) reports nothing.

Defined results: a null text counts as empty and has no spans; offsets are code points, ends
exclusive; repeated rows each give their row; an empty table gives no rows; other columns are
ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import free

# Fixed values of the base contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # greedy runs of 18+ in all
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
BAND_STARTS = (20, 32, 48, 96)
BINS_PER_E = 8  # bins of the p-value grid per unit of -ln(p)
MAX_BIN = 800
FDR, DECOYS = 0.05, 16
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, op, start: Column) -> Column:
    """Running results of op(acc, value), a value's own included; op is associative, start its identity.

    Arrays grow by copies, so they are kept short: pieces of about the square root of the size each run on
    their own, and then from what the pieces before them come to.
    """
    typed = F.array(start)

    def fold(part: Column, first: Column) -> Column:
        zero = F.struct(first.alias("at"), F.slice(typed, F.lit(1), F.lit(0)).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            return let(op(acc["at"], x), lambda now: F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out")))

        return F.aggregate(part, zero, step, lambda acc: acc["out"])

    def pieces(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int")
        return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.slice(v, i * width + 1, width))

    def joined_(parts: Column) -> Column:
        whole = F.transform(parts, lambda p: F.aggregate(p, start, lambda acc, x: op(acc, x)))
        ends = fold(whole, start)
        before = let(ends, lambda e: F.concat(typed, F.slice(e, F.lit(1), F.size(e) - 1)))
        return F.flatten(F.zip_with(parts, before, fold))

    return let(values, lambda v: F.when(F.size(v) == 0, F.slice(typed, F.lit(1), F.lit(0))).otherwise(let(pieces(v), joined_)))


SPAN = "array<struct<start:bigint,kind:int,end:bigint,token:string>>"


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """array<struct<start,kind,end,token>> of the leftmost non-overlapping matches; keep filters by match text."""

    def lay(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        steps = F.zip_with(gaps, hits, lambda g, h: (F.length(g) + F.length(h)).cast("long"))
        ends = running(steps, lambda a, x: a + x, F.lit(0).cast("long"))
        return F.zip_with(ends, hits, lambda end, h: F.struct((end - F.length(h)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), h.alias("token")))

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lay)
    kept = F.filter(spans, lambda s: keep(s["token"])) if keep else spans
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Sorted spans of the three fixed kinds, with their text."""
    long_value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 12
    return F.array_sort(F.concat(_spans(text, ASSIGN, 0, long_value), _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal (Abramowitz and Stegun 26.2.17, absolute error 7.5e-8)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-a * a / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def alphabet(token: Column) -> Column:
    """The smallest usual alphabet that holds the token, in symbol order."""
    return (
        F.when(token.rlike("^[0-9a-f]+$"), DIGITS + "abcdef")
        .when(token.rlike("^[0-9A-F]+$"), DIGITS + "ABCDEF")
        .when(token.rlike("^[A-Z2-7]+$"), UPPER + "234567")
        .when(token.rlike("^[0-9a-z]+$"), DIGITS + LOWER)
        .when(token.rlike("^[0-9A-Z]+$"), DIGITS + UPPER)
        .when(token.rlike("^[0-9A-Za-z]+$"), DIGITS + UPPER + LOWER)
        .when(token.rlike("^[0-9A-Za-z+/]+$"), UPPER + LOWER + DIGITS + "+/")
        .when(token.rlike("^[0-9A-Za-z_-]+$"), UPPER + LOWER + DIGITS + "-_")
        .otherwise(UPPER + LOWER + DIGITS + "+/-_")
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def p_value(token: Column) -> Column:
    """Fisher-combined p-value of the three tests under "uniform draw from the alphabet"."""

    def values(t: Column) -> Column:
        v = F.transform(F.split(t["token"], ""), lambda c: F.instr(t["symbols"], c).cast("double") - 1)
        return F.struct(t["token"].alias("token"), v.alias("v"), F.length(t["symbols"]).cast("double").alias("k"), F.length(t["token"]).cast("double").alias("n"))

    def parts(t: Column) -> Column:
        high = F.transform(t["v"], lambda x: F.when(x >= t["k"] / 2, 1.0).otherwise(0.0))
        counts = F.transform(F.array_distinct(F.split(t["token"], "")), lambda c: F.pow(t["n"] - F.length(F.replace(t["token"], c, F.lit(""))), F.lit(2.0)))
        mid = _sum(t["v"]) / t["n"]
        return F.struct(t["v"].alias("v"), t["k"].alias("k"), t["n"].alias("n"), high.alias("high"), mid.alias("mid"), _sum(counts).alias("squares"))

    def sums(t: Column) -> Column:
        shifted = lambda x: (F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1))
        runs = 1 + _sum(F.zip_with(*shifted(t["high"]), lambda a, b: F.abs(a - b)))
        power = _sum(F.transform(t["v"], lambda x: (x - t["mid"]) * (x - t["mid"])))
        lag = _sum(F.zip_with(*shifted(t["v"]), lambda a, b: (a - t["mid"]) * (b - t["mid"])))
        chi = F.greatest(t["squares"] * t["k"] / t["n"] - t["n"], F.lit(1e-9))
        return F.struct(t["k"].alias("k"), t["n"].alias("n"), _sum(t["high"]).alias("up"), runs.alias("runs"), power.alias("power"), lag.alias("lag"), chi.alias("chi"))

    def combined(t: Column) -> Column:
        n, df = t["n"], t["k"] - 1
        h = 2 / (9 * df)
        p1 = _tail((F.pow(t["chi"] / df, F.lit(1 / 3)) - (1 - h)) / F.sqrt(h))
        mean = 2 * t["up"] * (n - t["up"]) / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p2 = F.when(var <= 0, F.exp(-n * 0.6931471805599453) * 2).otherwise(2 * _tail(F.abs(t["runs"] - mean) / F.sqrt(F.greatest(var, F.lit(1e-9)))))
        p3 = F.when(t["power"] <= 0, F.lit(1e-9)).otherwise(2 * _tail(F.abs(t["lag"] / F.greatest(t["power"], F.lit(1e-9)) + 1 / n) * F.sqrt(n)))
        floor = F.lit(1e-30)
        logs = -(F.log(F.greatest(p1, floor)) + F.log(F.greatest(p2, floor)) + F.log(F.greatest(p3, floor)))
        return let(logs, lambda x: F.least(F.exp(-x) * (1 + x + x * x / 2), F.lit(1.0)))

    start = let(token, lambda t: F.struct(t.alias("token"), alphabet(t).alias("symbols")))
    return let(let(let(let(start, values), parts), sums), combined)


def _bin(p: Column) -> Column:
    """Grid bin of a score; bin 0 holds the highest, bin b those of at most exp(-b / BINS_PER_E)."""
    return F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * BINS_PER_E), F.lit(MAX_BIN)).cast("int")


def _band(length: Column) -> Column:
    out = F.lit(0)
    for i, start in enumerate(BAND_STARTS):
        out = F.when(length >= start, i).otherwise(out)
    return out


def candidates(text: Column) -> Column:
    """Runs that could be encoded random bytes: letters mixed with digits."""
    runs = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    return F.filter(runs, _mixed)


def _mixed(t: Column) -> Column:
    return t.rlike("[0-9]") & t.rlike("[A-Za-z]")


WIDTH = 256  # characters of a slice


def sliced(text: Column) -> Column:
    """Slices of a text, so that what stands at a place is found without a walk from its begin."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{WIDTH}}}"), F.lit(0))


def between(slices: Column, start: Column, end: Column) -> Column:
    """Characters start to end (exclusive, from 0) of a sliced text."""
    first = F.floor(start / WIDTH)
    near = F.array_join(F.transform(F.sequence(first, F.floor((end - 1) / WIDTH)), lambda i: F.get(slices, i.cast("int"))), "")
    return F.when(end <= start, F.lit("")).otherwise(F.substring(near, (start - first * WIDTH + 1).cast("int"), (end - start).cast("int")))


def decoy(token: Column, prose: Column, number: Column) -> Column:
    """token with its letters replaced by consecutive letters of prose (slices, n, text), from a place that
    number gives, in the token's cases. Prose shorter than the token is repeated."""
    n = F.length(token)
    times = (F.ceil(n / prose["n"]) + 1).cast("int")
    size = F.when(prose["n"] >= n, prose["n"]).otherwise(prose["n"] * times).cast("long")

    def letters(place: Column) -> Column:
        found = F.when(prose["n"] >= n, between(prose["slices"], place, place + n)).otherwise(F.substring(F.repeat(F.array_join(prose["slices"], ""), times), (place + 1).cast("int"), n))
        return F.split(found, "")

    own = lambda c, x: F.when(c.rlike("[A-Z]"), F.upper(x)).when(c.rlike("[a-z]"), F.lower(x)).otherwise(c)
    return F.array_join(F.zip_with(F.split(token, ""), let(F.pmod(F.xxhash64(token, number), size - n + 1), letters), own), "")


def score_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """band, bin, targets, decoys: how many candidates and decoys of the corpus have their score there.

    A document's letters stay in one place; only bands, bins and numbers leave it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(text.alias("text"), candidates(text).alias("found")).filter(F.size("found") > 0)
    letters = F.regexp_replace(F.regexp_replace("text", CANDIDATE, " "), "[^A-Za-z]+", "")
    prose = let(letters, lambda x: F.struct(sliced(x).alias("slices"), F.length(x).alias("n")))

    def scored(doc: Column) -> Column:
        numbers = F.when(doc["prose"]["n"] > 0, F.sequence(F.lit(0), F.lit(DECOYS))).otherwise(F.array(F.lit(0)))

        def tried(token: Column) -> Column:
            one = lambda i: F.when(i == 0, token).otherwise(decoy(token, doc["prose"], i))
            return F.transform(numbers, lambda i: F.struct(_band(F.length(token)).alias("band"), _bin(p_value(one(i))).alias("bin"), i.alias("number")))

        return F.flatten(F.transform(doc["found"], tried))

    each = found.select(F.explode(let(F.struct("found", prose.alias("prose")), scored)).alias("s")).select("s.*")
    return each.groupBy("band", "bin").agg(F.count_if(F.col("number") == 0).alias("targets"), F.count_if(F.col("number") > 0).alias("decoys"))


def report_bins(counts: DataFrame, fdr: float = FDR) -> DataFrame:
    """One row: map of length band to the last bin that is reported (bands that report nothing are absent).

    Benjamini-Hochberg: with N candidates in a band, R(b) of them up to bin b, and q(b) = (1 + decoys up
    to b) / (1 + decoys), the last b with q(b) <= fdr * R(b) / N.
    """
    band, upto = Window.partitionBy("band"), Window.partitionBy("band").orderBy("bin")  # some hundred bins a band
    q = (1 + F.sum("decoys").over(upto)) / (1 + F.sum("decoys").over(band))
    share = F.sum("targets").over(upto) / F.sum("targets").over(band)
    passed = counts.select("band", "bin", q.alias("q"), share.alias("share")).filter(F.col("q") <= F.lit(fdr) * F.col("share"))
    last = passed.groupBy("band").agg(F.max("bin").alias("bin"))
    return last.agg(F.map_from_entries(F.collect_list(F.struct("band", "bin"))).alias("cuts"))


def _apart(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span: in the order of starts no base span before one reaches beyond its
    start, and the next one begins behind its end."""
    none, far = F.lit(0).cast("long"), F.lit(1 << 60)

    def marked(every: Column) -> Column:
        fixed = lambda x: x["kind"] < 3
        reach = running(F.transform(every, lambda x: F.when(fixed(x), x["end"]).otherwise(none)), F.greatest, none)
        ahead = F.reverse(running(F.reverse(F.transform(every, lambda x: F.when(fixed(x), x["start"]).otherwise(far))), F.least, far))
        return F.zip_with(F.zip_with(every, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r"))), ahead, lambda y, a: F.struct(y["x"].alias("x"), y["r"].alias("r"), a.alias("a")))

    free_ = F.filter(let(F.array_sort(F.concat(base, runs)), marked), lambda m: (m["x"]["kind"] == 3) & (m["r"] <= m["x"]["start"]) & (m["a"] >= m["x"]["end"]))
    return F.transform(free_, lambda m: m["x"])


def scan(docs: DataFrame, text_col: str = "text", fdr: float = FDR, out_col: str = "secrets") -> DataFrame:
    """docs with a column out_col: array<struct<start,kind,end>>, sorted; kind indexes KINDS. A column of
    that name is replaced; no other name can clash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, runs, cuts = (free(n, [*docs.columns, out_col]) for n in ("base", "runs", "cuts"))
    bins = report_bins(score_counts(docs, text_col), fdr).withColumnRenamed("cuts", cuts)
    found = docs.withColumns({base: base_spans(text), runs: _spans(text, CANDIDATE, 3, _mixed)})

    def reported(s: Column) -> Column:
        last = F.element_at(F.col(cuts), _band(s["end"] - s["start"]))
        return F.when(last.isNull(), False).otherwise(_bin(p_value(s["token"])) <= last)

    extra = F.when(F.size(runs) == 0, F.col(runs)).otherwise(F.filter(_apart(F.col(base), F.col(runs)), reported))
    spans = F.transform(F.array_sort(F.concat(base, extra)), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.crossJoin(F.broadcast(bins)).withColumn(out_col, spans).drop(base, runs, cuts)  # bins: one row


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in span order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """docs with every secret span of the text replaced by mark; overlapping spans share one mark.
    Texts without secrets, nulls among them, stay as they are."""
    spans, zero = free("secrets", docs.columns), F.lit(0).cast("long")

    def cut_out(doc: Column) -> Column:
        reach = doc["reach"]  # how far the spans up to each one go
        before = F.concat(F.array(zero), F.slice(reach, F.lit(1), F.size(reach) - 1))
        gaps = F.zip_with(doc["spans"], before, lambda s, done: F.when(s["start"] >= done, F.concat(between(doc["slices"], done, s["start"]), F.lit(mark))))
        end = F.element_at(reach, -1)
        return F.concat(F.array_join(F.array_compact(gaps), ""), between(doc["slices"], end, doc["n"].cast("long")))

    text = F.col(text_col)
    reach = running(F.transform(spans, lambda s: s["end"]), F.greatest, zero)
    doc = F.struct(F.col(spans).alias("spans"), reach.alias("reach"), sliced(text).alias("slices"), F.length(text).alias("n"))
    clean = F.when(F.size(spans) == 0, text).otherwise(let(doc, cut_out))
    return scan(docs, text_col, fdr, spans).withColumn(text_col, clean).drop(spans)


def query(docs: DataFrame) -> DataFrame:
    """The registered digest: counts per fixed kind, hash of the fixed spans, all spans."""
    count = lambda i: F.size(F.filter("secrets", lambda s: s["kind"] == i)).cast("long")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        count(3).alias("n_random"),
    )
