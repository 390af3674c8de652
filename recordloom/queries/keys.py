"""Normalisation keys over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import keys as K

from .registry import query

#: Dirty names: ``#`` spelled out, every fifth row in lower case with doubled blanks.
DIRTY = "case when s_suppkey % 5 = 0 then replace(lower(replace(s_name, '#', ' & Co. LLC ')), ' ', '  ') else replace(s_name, '#', ' & Co. LLC ') end"
#: Letter by letter, then the words again with single blanks.
LETTERS = "list_transform(string_split(upper(n), ''), lambda c: case when c = '&' then ' AND ' when c in ('-', '–', '—') then ' ' when strpos('ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ', c) > 0 then c else '' end)"
NAME_SQL = f"nullif(array_to_string(list_filter(string_split(array_to_string({LETTERS}, ''), ' '), lambda w: w <> ''), ' '), '')"
#: A URL taken apart at its separators, one after the other.
HOST_SQL = """with u as (select page_id, lower(trim(url)) as u from pages),
    r as (select page_id, case when starts_with(u, 'https://') then substr(u, 9) when starts_with(u, 'http://') then substr(u, 8) else u end as rest from u),
    p as (select page_id, string_split(string_split(rest, '/')[1], '@') as parts from r),
    w as (select page_id, case when len(parts) > 1 then array_to_string(parts[2:], '@') else parts[1] end as own from p),
    c as (select page_id, string_split(string_split(string_split(case when starts_with(own, 'www.') then substr(own, 5) else own end, ':')[1], '?')[1], '#')[1] as own from w),
    h as (select page_id, trim(own, '.') as host from c)"""
#: More than one label, and a last one of two letters or more.
DOMAIN_SQL = """len(string_split(host, '.')) > 1 and length(host) >= 4 and length(host) <= 253 and not contains(host, ' ')
    and length(string_split(host, '.')[-1]) >= 2 and len(list_filter(string_split(string_split(host, '.')[-1], ''), lambda c: c < 'a' or c > 'z')) = 0"""


@query("n01_name_norm", f"with d as (select s_suppkey, {DIRTY} as n from supplier) select s_suppkey, {NAME_SQL} as name_key from d")
def n01(t):
    return t.supplier.select("s_suppkey", K.name_norm(F.expr(DIRTY)).alias("name_key"))


@query("n02_legal_name_base", f"with d as (select s_suppkey, replace(s_name, '#', ' ') || ' Co LLC' as n from supplier) select s_suppkey, nullif(trim(regexp_replace({NAME_SQL}, '( (LLC|INC|CORP|CO|LTD|PLC))+$', '', 'g')), '') as base from d")
def n02(t):
    return t.supplier.select("s_suppkey", K.legal_name_base(K.name_norm(F.expr("replace(s_name, '#', ' ') || ' Co LLC'"))).alias("base"))


@query("n03_bare_host", f"{HOST_SQL} select page_id, host from h")
def n03(t):
    return t.pages.select("page_id", K.bare_host(F.col("url")).alias("host"))


@query("n04_normalized_domain", f"{HOST_SQL} select page_id, case when {DOMAIN_SQL} then host end as domain from h")
def n04(t):
    return t.pages.select("page_id", K.normalized_domain(K.bare_host(F.col("url"))).alias("domain"))


@query("n05_registrable_domain", "select page_id, regexp_extract(regexp_replace(regexp_replace(lower(trim(url)), '^([a-z][a-z0-9+.-]*://)+', ''), '[/:?#].*$', ''), '([^.]+\\.[^.]+)$', 1) as domain from pages")
def n05(t):
    return t.pages.select("page_id", K.registrable_domain(F.col("url")).alias("domain"))


@query("n06_is_generic_domain", "select s_suppkey, (s_suppkey % 3 = 0) as generic from supplier")
def n06(t):
    host = F.when(F.col("s_suppkey") % 3 == 0, F.lit("gmail.com")).otherwise(F.concat(F.lit("supplier"), F.col("s_suppkey"), F.lit(".example.com")))
    return t.supplier.select("s_suppkey", K.is_generic_domain(host).alias("generic"))


@query("n07_linkedin_slug", "select s_suppkey, case when s_suppkey % 2 = 0 then lower(replace(s_name, '#', '-')) end as slug from supplier")
def n07(t):
    url = F.concat(F.lit("https://WWW.LinkedIn.com/"), F.when(F.col("s_suppkey") % 2 == 0, "company/").otherwise("in/"), F.regexp_replace("s_name", "#", "-"), F.lit("/?x=1"))
    return t.supplier.select("s_suppkey", K.linkedin_slug(url).alias("slug"))


@query("n08_phone_e164", "select c_custkey, case when c_custkey % 4 <> 0 then '+1212' || lpad(cast(2000000 + c_custkey as varchar), 7, '0') end as phone from customer")
def n08(t):
    number = F.lpad((2_000_000 + F.col("c_custkey")).cast("string"), 7, "0")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("(012) "), number)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("1-212-"), number, F.lit(" ext. 4"))).otherwise(F.concat(F.lit("(212) "), F.substring(number, 1, 3), F.lit("-"), F.substring(number, 4, 4)))
    return t.customer.select("c_custkey", K.phone_e164(raw).alias("phone"))


@query("n09_person_key", "select doc_id, nullif(array_to_string(list_sort(list_filter(string_split_regex(lower(strip_accents(text)), '[^a-z]+'), lambda x: len(x) >= 2 and not list_contains(['jr','sr','ii','iii','iv','v','md','phd','cpa','esq','pe','mba','jd','dds'], x))), ' '), '') as person from documents")
def n09(t):
    return t.documents.select("doc_id", K.person_key(F.col("text")).alias("person"))


@query("n10_addr_hash", "select c_custkey, md5(c_custkey || ' MAIN ST.|SPRINGFIELD|IL|' || lpad(cast(10000 + c_custkey as varchar), 5, '0')) as addr_hash from customer")
def n10(t):
    key = F.col("c_custkey")
    return t.customer.select("c_custkey", K.addr_hash(F.concat(key, F.lit("  Main St.")), F.lit(" Springfield "), F.lit("il"), F.concat(F.lpad((10_000 + key).cast("string"), 5, "0"), F.lit("-1234"))).alias("addr_hash"))


@query("n11_place_key", "select n_nationkey, 'ST ' || replace(n_name, '_', '_') as place from nation")
def n11(t):
    return t.nation.select("n_nationkey", K.place_key(F.concat(F.lit(" Saint "), F.col("n_name"), F.lit(" County"))).alias("place"))


@query("n12_fold_key", "select distinct p_name, replace(p_name, ' ', '') as fold from part")
def n12(t):
    return t.part.select("p_name", K.fold_key(F.concat(F.lower("p_name"), F.lit("s"))).alias("fold")).distinct()


@query("n13_email_parts", "select c_custkey, 'user' || c_custkey || '@mail' || c_nationkey || '.example.com' as email, 'user' || c_custkey as local, 'mail' || c_nationkey || '.example.com' as domain from customer")
def n13(t):
    raw = F.concat(F.lit(" User"), F.col("c_custkey"), F.lit("@Mail"), F.col("c_nationkey"), F.lit(".Example.COM "))
    return t.customer.select("c_custkey", K.email_parts(raw).alias("p")).select("c_custkey", "p.*")
