"""Normalisation keys: column in, column out; null where nothing usable is left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key rules.
LEGAL_SUFFIXES = "LLC INC CORP CO LTD PLC".split()
SECOND_LEVEL = "co com org net gov edu ac gob go".split()
PERSON_SUFFIXES = "jr sr ii iii iv v md phd cpa esq pe mba jd dds".split()
PLACE_SUFFIXES = ["COUNTY", "PARISH", "BOROUGH", "CENSUS AREA", "MUNICIPALITY", "MUNICIPIO", "CITY AND BOROUGH", "CITY", "DISTRICT", "ISLAND", "ISLANDS"]
GENERIC_DOMAINS = """
gmail.com yahoo.com hotmail.com outlook.com aol.com icloud.com msn.com live.com protonmail.com proton.me ymail.com
gmx.com mail.com me.com facebook.com web.facebook.com m.facebook.com fb.com instagram.com twitter.com x.com youtube.com
youtu.be linkedin.com linktr.ee medium.com wordpress.com blogspot.com sites.google.com g.page behance.net wa.me t.me
calendly.com indiamart.com yelp.com etsy.com amazon.com ebay.com tiktok.com pinterest.com github.io wixsite.com
weebly.com godaddysites.com comcast.net att.net verizon.net sbcglobal.net bellsouth.net cox.net charter.net
frontier.com earthlink.net roadrunner.com windstream.net centurylink.net optonline.net juno.com netzero.net mac.com
rocketmail.com gvtc.com psychologytoday.com veteranownedbusiness.com mybaseguide.com orcid.org agents.allstate.com
newyorklife.com kw.com drive.google.com docs.google.com acrobat.adobe.com storage.googleapis.com canva.com dropbox.com
google.com share.google tinyurl.com tiny.cc fedlinks.com doitbest.com avoyatravel.com johncmaxwellgroup.com
napaonline.com uhaul.com snap.com stores.ebay.com advantaclean.com uslawns.com redboxplus.com myvoda.com
greasemonkeyauto.com
""".split()
ACCENTED = "ÁÀÂÄÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝáàâäãåçéèêëíìîïñóòôöõúùûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"


def blank_null(col: Column) -> Column:
    """Trimmed text, null if empty."""
    return F.nullif(F.trim(col), F.lit(""))


def _chain(col: Column, *steps: tuple[str, str]) -> Column:
    for pattern, put in steps:
        col = F.regexp_replace(col, pattern, put)
    return col


def name_norm(col: Column) -> Column:
    """Organisation key: upper case, & as AND, dashes as blanks, other marks dropped."""
    return blank_null(_chain(F.upper(col.cast("string")), ("&", " AND "), ("[-\u2013\u2014]+", " "), ("[^A-Z0-9 ]+", ""), (r"\s+", " ")))


def legal_name_base(norm: Column) -> Column:
    """A name_norm key without trailing corporate designators."""
    return blank_null(F.regexp_replace(norm, f"( ({'|'.join(LEGAL_SUFFIXES)}))+$", ""))


# The patterns are fixed values of the rule.
def bare_host(col: Column) -> Column:
    """Host of a URL or web address."""
    host = _chain(F.lower(F.trim(col.cast("string"))), ("^https?://", ""), ("^[^/@]*@", ""), (r"^www\.", ""), ("[/:?#].*$", ""))
    return F.regexp_replace(host, r"^\.+|\.+$", "")


# The lengths and the pattern are fixed values of the rule.
def normalized_domain(host: Column) -> Column:
    """A bare host that could be a domain, else null."""
    fits = host.contains(".") & F.length(host).between(4, 253) & ~host.contains(" ") & host.rlike(r"\.[a-z]{2,}$")
    return F.when(fits, host)


# The patterns are fixed values of the rule.
def registrable_domain(col: Column) -> Column:
    """Last two labels, or three under a two-level country suffix; no addresses by number."""
    host = _chain(F.lower(F.trim(col)), ("^([a-z][a-z0-9+.-]*://)+", ""), ("^[^/@]*@", ""), ("[/:?#].*$", ""), (r"^www\.", ""), ("[^a-z0-9.-]", ""))
    labels = F.split(host, r"\.")
    size = F.size(labels)
    three = (size >= 3) & F.try_element_at(labels, F.lit(-2)).isin(SECOND_LEVEL) & (F.length(F.try_element_at(labels, F.lit(-1))) == 2)
    found = F.when(three, F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)).otherwise(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
    good = found.rlike(r"^([a-z0-9]([a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}$") & ~host.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    return F.when(good, found)


def is_generic_domain(domain: Column) -> Column:
    """Whether a domain is a shared host; null for null."""
    return domain.isin(GENERIC_DOMAINS)


# The pattern is a fixed value of the rule.
def linkedin_slug(col: Column) -> Column:
    """Company or school slug of a profile URL."""
    return F.nullif(F.regexp_extract(F.lower(col.cast("string")), r"linkedin\.com/(?:company|school)/([^/?#]+)", 1), F.lit(""))


# The patterns are fixed values of the rule.
def phone_e164(col: Column) -> Column:
    """North American number as +1 and ten digits."""
    digits = _chain(col, (r"(?i)\s*(ext|extension|x|#)\.?\s*[0-9]+\s*$", ""), ("[^0-9]", ""))
    ten = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).when(F.length(digits) == 10, digits)
    return F.when(ten.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$"), F.concat(F.lit("+1"), ten))


def strip_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, PLAIN)


def person_key(col: Column) -> Column:
    """Sorted name tokens of two letters or more without titles."""
    parts = F.split(F.lower(strip_accents(F.coalesce(col, F.lit("")))), "[^a-z]+")
    kept = F.filter(parts, lambda t: (F.length(t) >= 2) & ~t.isin(PERSON_SUFFIXES))
    return F.nullif(F.array_join(F.array_sort(kept), " "), F.lit(""))


def zip5(col: Column) -> Column:
    """First five digits, null if there are none."""
    return F.nullif(F.substring(F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", ""), 1, 5), F.lit(""))


def addr_key(street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    up = lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.concat_ws("|", F.regexp_replace(up(street), r"\s+", " "), up(city), up(state), F.coalesce(zip5(zip_code), F.lit("")))


def addr_hash(street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """MD5 of the address key."""
    return F.md5(addr_key(street, city, state, zip_code))


# The patterns are fixed values of the rule.
def place_key(col: Column) -> Column:
    """County or place name without marks and kind words."""
    name = _chain(F.upper(F.trim(strip_accents(col))), ("[.\u2019'(),]", ""), (r"\s+", " "), ("^SAINT ", "ST "), ("^(DE|DU|LA) (?=[A-Z])", "$1"))
    return F.regexp_replace(name, rf"(\s+({'|'.join(PLACE_SUFFIXES)}))+$", "")


# Last tokens in s that are no plural.
NO_PLURAL = """gas lens bus chassis apparatus series species analysis axis basis ppe gps ups plus bias iris
canvas atlas status focus radius census virus bonus campus cactus""".split()


def singular(col: Column) -> Column:
    """The phrase with its last token made singular; the patterns are fixed values of the rule."""
    return (
        F.when(F.element_at(F.split(col, r"\s"), -1).isin(NO_PLURAL), col)
        .when(col.rlike("[a-z]{2,}ies$"), F.regexp_replace(col, "ies$", "y"))
        .when(col.rlike("(sses|xes|zes|ches|shes)$"), F.regexp_replace(col, "es$", ""))
        .when(col.rlike("[a-z]{3,}s$") & ~col.rlike("[sui]s$"), F.regexp_replace(col, "s$", ""))
        .otherwise(col)
    )


# The patterns are fixed values of the rule.
def fold_key(col: Column) -> Column:
    """Singular phrase without separators."""
    return F.regexp_replace(singular(col), "[ \\-\u2013\u2014/_'.]", "")


def email_parts(col: Column) -> Column:
    """struct<email, local, domain> of an address in normal form."""
    email = blank_null(F.lower(col))
    good = email.rlike(r"^[^@\s]+@[^@\s]+\.[a-z]{2,}$")
    part = lambda i: F.when(good, F.split_part(email, F.lit("@"), F.lit(i)))
    return F.struct(F.when(good, email).alias("email"), part(1).alias("local"), part(2).alias("domain"))
