"""Text and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions.keys import bare_host
from recordloom.operators import text as T
from recordloom.operators import vectors as V

from .registry import query

EMAIL, IP = "[a-z]+@[a-z.]+[a-z]", "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"


SPACED = "trim(regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))"
PLACE = "case when {p} <= 0 then 0 when {p} >= n then n when strpos(reverse(substr(b, {p} - 199, 200)), ' ') > 0 then {p} - strpos(reverse(substr(b, {p} - 199, 200)), ' ') + 1 else {p} end"


@query(
    "t01_chunk",
    f"""with t as (select doc_id, {SPACED} as b from documents), u as (select doc_id, b, length(b) as n from t where b <> ''), c as (select *, unnest(range(0, greatest(cast(ceil((n - 200) / 1800.0) as bigint), 1))) as chunk from u),
    p as (select doc_id, chunk, b, {PLACE.format(p="(chunk * 1800)")} as first, {PLACE.format(p="(chunk * 1800 + 2000)")} as stop from c)
    select doc_id, cast(chunk as integer) as chunk, cast(first as integer) as offset, substr(b, first + 1, stop - first) as piece from p""",
)
def t01(t):
    return T.chunk(t.documents, "doc_id", "text")


@query("t02_reassemble", "select doc_id, sha256(trim(regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))) as digest from documents where trim(text, ' ' || chr(10) || chr(9)) <> ''")
def t02(t):
    return T.reassemble(T.chunk(t.documents, "doc_id", "text"), "doc_id").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("t03_dedup_exact", "select doc_id, sha256(text) as content_hash, min(doc_id) over (partition by text) as canonical_id, count(*) over (partition by text) as copies from documents")
def t03(t):
    return T.dedup_exact(t.documents, "doc_id", "text")


@query("t04_triage", "select doc_id, case when regexp_matches(substr(text, 1, 200), 'Copyright|License|Licensed') then 'license' when regexp_matches(substr(text, 1, 200), '\\|') then 'table' when regexp_matches(substr(text, 1, 200), '[A-Z]{4,}') then 'shout' else 'unknown' end as class, regexp_matches(text, 'clown|pathetic|scum') as hit from documents")
def t04(t):
    kind, hit = T.triage(F.col("text"), 200, {"license": "Copyright|License|Licensed", "table": r"\|", "shout": "[A-Z]{4,}"}, "clown|pathetic|scum")
    return t.documents.select("doc_id", kind.alias("class"), hit.alias("hit"))


@query("t05_markings", f"select doc_id, concat_ws(',', case when regexp_matches(text, '{EMAIL}') then 'email' end, case when regexp_matches(text, '{IP}') then 'address' end, case when doc_id % 2 = 0 then 'kept' end) as marks from documents")
def t05(t):
    new = T.markings(F.col("text"), {"email": EMAIL, "address": IP})
    old = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("kept")))
    return t.documents.select("doc_id", F.array_join(T.promote(new, old), ",").alias("marks"))


NO = "not |never |no |nicht |pas "
FOUND = "select doc_id, text, '{f}' as family, unnest(regexp_extract_all(text, '{p}')) as value, generate_subscripts(regexp_extract_all(text, '{p}'), 1) as i, regexp_extract_all(text, '{p}') as vs, string_split_regex(text, '{p}') as gs from documents where regexp_matches(text, '{p}')"


@query(
    "t06_extract",
    f"""with m as ({FOUND.format(f='email', p=EMAIL)} union all {FOUND.format(f='address', p=IP)}),
    o as (select *, cast(list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(vs[1:i-1], lambda x: length(x))), 0) as bigint) as start from m),
    q as (select *, start + length(value) as stop, substr(text, greatest(start - 30, 0) + 1, start + length(value) + 30 - greatest(start - 30, 0)) as quote from o where not regexp_matches(substr(text, greatest(start - 60, 0) + 1, least(start, 60)), '({NO})[^.]{{0,40}}$')),
    r as (select *, row_number() over (partition by doc_id, family, value order by start) as rn, count(*) over (partition by doc_id, family, value) as n, bool_or(regexp_matches(quote, 'must|shall|required')) over (partition by doc_id, family, value) as mandatory from q)
    select doc_id, family, value, n, start, stop as "end", quote, mandatory from r where rn = 1""",
)
def t06(t):
    out = T.extract(t.documents, "doc_id", "text", {"email": EMAIL, "address": IP}, NO)
    return out.withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})


@query("t07_designations")
def t07(t):
    return T.designations(t.documents, "doc_id", "text", {"clown": "clown", "scum": "scum", "pathetic": "pathetic"}, NO)


CODE = r"\d{5,}"  # customers' keys have no bound


def _register(t):
    line = F.concat(F.lit("  "), (10000 + F.col("c_custkey")).cast("string"), F.lit(" "), "c_mktsegment", F.lit(".....$ "), (F.col("c_custkey") % 50).cast("string"), F.lit(".25"))
    odd = F.when(F.col("c_custkey") % 9 == 0, F.lit("rate 9.99 unread")).otherwise(line)
    return t.customer.groupBy((F.col("c_nationkey") * 1_000_000 + F.floor(F.col("c_custkey") / 500)).alias("register")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", odd.alias("l")))), lambda r: r["l"]), "\n").alias("document"))


@query("t08_parse_register", "select c_nationkey * 1000000 + cast(floor(c_custkey / 500) as bigint) as register, cast(10000 + c_custkey as varchar) as code, c_mktsegment as title, c_custkey % 50 + 0.25::double as rate from customer where c_custkey % 9 <> 0")
def t08(t):
    return T.parse_register(_register(t), "register", "document", CODE)[0]


@query("t08_parse_register_rest", "select c_nationkey * 1000000 + cast(floor(c_custkey / 500) as bigint) as register, count(*) as n from customer where c_custkey % 9 = 0 group by 1")
def t08_rest(t):
    return T.parse_register(_register(t), "register", "document", CODE)[1].groupBy("register").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t09_sections",
    """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
    s as (select *, sum(case when regexp_matches(line, '^[A-Z][a-z]+[.]') then 1 else 0 end) over (partition by doc_id order by i rows unbounded preceding) as section from l)
    select doc_id, cast(section as bigint) as section, max(case when regexp_matches(line, '^[A-Z][a-z]+[.]') then line end) as title, count(*) as n_lines, sum(length(line))::bigint as n_chars from s group by 1, 2""",
)
def t09(t):
    return T.sections(t.documents, "doc_id", "text", "^[A-Z][a-z]+[.]")


@query("t10_mentions", "with m as (select p_partkey, trim(unnest(string_split(lower(p_name), ' '))) as form from part) select replace(form, ' ', '') as fold, form, count(*) as n_mentions, count(distinct p_partkey) as n_keys from m group by 1, 2")
def t10(t):
    return T.mentions(t.part, "p_partkey", "p_name", " ")


@query("t11_bucket", "select p_partkey, case when regexp_matches(p_name, 'gear|bolt') then 'hardware' when regexp_matches(p_name, 'ring|gizmo') then 'trinket' else 'other' end as bucket from part")
def t11(t):
    return t.part.select("p_partkey", T.bucket(F.col("p_name"), [("gear|bolt", "hardware"), ("ring|gizmo", "trinket")], "other").alias("bucket"))


@query("t12_title_class", "select c_custkey, case when regexp_matches(c_mktsegment, '^(BUILD|MACH)') then 'decision' when regexp_matches(c_mktsegment, 'HOLD$') then 'influence' else 'none' end as class from customer")
def t12(t):
    return t.customer.select("c_custkey", T.bucket(F.col("c_mktsegment"), [("^(BUILD|MACH)", "decision"), ("HOLD$", "influence")], "none").alias("class"))


ALIASES = [("red", "color", "R"), ("blue", "color", "B"), ("small", "size", "S"), ("big", "size", "L")]
ALIAS_SQL = "a as (select * from (values ('red', 'color', 'R'), ('blue', 'color', 'B'), ('small', 'size', 'S'), ('big', 'size', 'L')) v(token, axis, code)), k as (select p_partkey, unnest(list_distinct(string_split(lower(p_name), ' '))) as token from part)"


def _axes(t):
    return T.normalise_axes(t.part, "p_partkey", F.col("p_name"), F.broadcast(t.spark.createDataFrame(ALIASES, "token string, axis string, code string")))


@query("t13_normalise_axes", f"with {ALIAS_SQL} select distinct p_partkey, axis, code from k join a using (token)")
def t13(t):
    return _axes(t)[0]


@query("t13_normalise_axes_rest", f"with {ALIAS_SQL} select p_partkey, token from k where token not in (select token from a)")
def t13_rest(t):
    return _axes(t)[1].select("p_partkey", "token")


@query("t14_alias_lookup", "with n as (select p_name, p_brand as code, p_size % 3 as priority from part) select p_name as query, code, priority from (select *, row_number() over (partition by p_name order by priority, code) as rn from n) where rn = 1")
def t14(t):
    aliases = t.part.select(F.col("p_name").alias("title"), F.col("p_brand").alias("code"), (F.col("p_size") % 3).alias("priority"))
    return T.alias_lookup(aliases, t.part.select(F.col("p_name").alias("query")).distinct())


TAGS = "select doc_id, case when quality = 1 then 'good' when toxic = 1 then 'weird' else 'bad' end as tag, case when l.doc_id % 3 = 0 then 'no such quote' else substr(text, 2, 12) end as quote, text from labels l join documents d using (doc_id)"


def _tags(t):
    own = t.labels.join(t.documents, "doc_id")
    tag = F.when(F.col("quality") == 1, "good").when(F.col("toxic") == 1, "weird").otherwise("bad")
    tags = own.select("doc_id", tag.alias("tag"), F.when(F.col("doc_id") % 3 == 0, F.lit("no such quote")).otherwise(F.substring("text", 2, 12)).alias("quote"))
    return T.validate_tags(tags, t.spark.createDataFrame([("good",), ("bad",)], "tag string"), t.documents, "doc_id", "text")


@query("t15_validate_tags", f"select doc_id, tag, quote from ({TAGS}) where tag in ('good', 'bad') and contains(text, quote)")
def t15(t):
    return _tags(t)[0].select("doc_id", "tag", "quote")


@query("t15_validate_tags_quarantine", f"select doc_id, case when tag not in ('good', 'bad') then 'tag' else 'quote' end as reason from ({TAGS}) where not (tag in ('good', 'bad') and contains(text, quote))")
def t15_quarantine(t):
    return _tags(t)[1].select("doc_id", "reason")


@query("t16_homepage_meta", "select page_id, nullif(trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)), '') as title, nullif(regexp_extract(html, '<html[^>]*lang=\"([^\"]*)\"', 1), '') as lang, false as parked from pages")
def t16(t):
    return T.homepage_meta(t.pages.withColumn("host", bare_host(F.col("url"))), "html").select("page_id", "title", "lang", "parked")


def _query_vector(t):
    return [float(x) for x in t.embeddings.filter("vec_id = 0").first().embedding]


Q = "(select embedding from embeddings where vec_id = 0)"
COS = "list_dot_product(cast({a} as double[]), cast({b} as double[])) / (sqrt(list_dot_product(cast({a} as double[]), cast({a} as double[]))) * sqrt(list_dot_product(cast({b} as double[]), cast({b} as double[]))))"


@query("v01_vector_search", f"select vec_id, round({COS.format(a='embedding', b=Q)}, 6) as cosine from embeddings where label % 2 = 0 order by 2 desc, 1 limit 10")
def v01(t):
    return V.vector_search(t.embeddings, "vec_id", "embedding", _query_vector(t), 10, F.col("label") % 2 == 0)


@query("v02_centroid_vec", "with m as (select label, i, avg(cast(x as double)) as m from (select label, unnest(embedding) as x, generate_subscripts(embedding, 1) as i from embeddings) group by 1, 2), n as (select label, sqrt(sum(m * m)) as n from m group by 1) select label, i - 1 as i, round(m / n, 6) as x from m join n using (label)")
def v02(t):
    return V.centroid_vec(t.embeddings, "label", "embedding").select("label", F.posexplode("embedding").alias("i", "x")).select("label", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


def _queries(t):
    return t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), "embedding")


V03_SQL = f"""with a as (select vec_id as query, embedding as e from embeddings where vec_id % 100 = 0), m as (select query, vec_id, round(1 - {COS.format(a='e', b='embedding')}, 6) as distance from a, embeddings where vec_id <> query)
    select query, vec_id, distance, rank from (select *, row_number() over (partition by query order by distance, vec_id) as rank from m) where rank <= 10"""


@query("v03_vector_match", V03_SQL)
def v03(t):
    own = _queries(t)
    same = own.select("query", F.col("query").alias("vec_id"))
    return V.vector_match(own, "query", t.embeddings, "vec_id", "embedding", 10, 2.1, same).withColumn("rank", F.col("rank").cast("long"))


@query("v04_ivf_assign")
def v04(t):
    return V.ivf_assign(t.embeddings, "embedding", V.cell_centres(t.embeddings, "embedding", 16)).select("vec_id", "cell")


# The vectors hardly cluster, so most cells are probed: by codes of 16 bytes. 100 vectors a query are compared whole.
CELLS, PROBES, PARTS, SHORTLIST = 16, 14, 16, 100


@query("v04_ivf_search")
def v04_search(t):
    centres = V.cell_centres(t.embeddings, "embedding", CELLS)
    books = V.codebooks(t.embeddings, "embedding", PARTS)
    return V.pq_search(_queries(t), "query", t.embeddings, "vec_id", "embedding", centres, books, PROBES, 10, SHORTLIST)


@query("v05_embed")
def v05(t):
    """Vectors of the odd documents, which have none, by a model learned from all documents."""
    own = t.documents.withColumn("vector", F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(0.0).cast("float"))))
    return V.embed(own, "doc_id", "text", "vector", V.word_model(t.spark, *V.word_vectors(t.documents, "text")))
