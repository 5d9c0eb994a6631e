"""URL functions as Column expressions (X1-X11, X18, X25-X26); all of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: RFC 3986, appendix B.  `parse_url` rejects hosts that the web does have.
SPLIT = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"

#: Countries whose registries have the plain second levels, and those.
PLAIN_SECONDS = "com net org gov edu mil"
PLAIN_COUNTRIES = "ag ai al az ba bb bh bm bn bo bs bt bz ci cu cw cy dm do dz et fj ge gh gi gn gt gu gy hn ht im iq is jm jo kg ki km kw ky kz la lb lc lk lr lv ly mg mk ml mo ms mt mu mv mw nf ni np nr om pa pf pg pr ps py qa ro sa sb sc sd sl sn so st sv sy tj tm tn to tt ug uz vc vi vu ws ye zm"
#: Other public suffixes of two labels (a subset of the public list; any other suffix is the last label).
SUFFIXES = tuple(
    f"{second}.{top}"
    for top, seconds in {
        "uk": "co org gov ac me net ltd plc sch nhs police mod",
        "au": "com net org edu gov id asn",
        "nz": "co net org govt ac school geek gen iwi maori",
        "jp": "co ne or go ac ad ed gr lg",
        "br": "com net org gov edu blog art",
        "in": "co net org gov ac edu res firm gen ind nic",
        "za": "co net org gov ac web law",
        "kr": "co or go ac ne re pe",
        "cn": "com net org gov edu ac",
        "tw": "com net org gov edu idv",
        "hk": "com net org gov edu idv",
        "sg": "com net org gov edu per",
        "my": "com net org gov edu",
        "mx": "com net org gob edu",
        "ar": "com net org gob edu",
        "co": "com net org gov edu",
        "tr": "com net org gov edu bel k12 web",
        "il": "co net org gov ac muni k12",
        "th": "co net or go ac in",
        "id": "co net or go ac web sch",
        "ua": "com net org gov edu in kiev",
        "pl": "com net org gov edu waw",
        "ru": "com msk spb",
        "es": "com org gob edu nom",
        "pt": "com org gov edu",
        "fr": "asso com gouv nom tm",
        "it": "gov edu",
        "at": "co or gv ac",
        "hu": "co org",
        "gr": "com net org gov edu",
        "vn": "com net org gov edu",
        "ph": "com net org gov edu",
        "pk": "com net org gov edu",
        "eg": "com net org gov edu",
        "ng": "com net org gov edu",
        "ke": "co or go ac ne",
        "pe": "com net org gob edu",
        "ve": "com co net org gob",
        "uy": "com net org gub edu",
        "ec": "com net org gob edu",
        "ae": "co net org sch ac gov mil",
        "ir": "ac co gov id net org sch",
        "rs": "co org edu ac gov in",
        "hr": "com from iz name",
        "ma": "co net gov org ac press",
        "mz": "ac adv co edu gov mil net org",
        "na": "co com org",
        "rw": "ac co coop gov mil net org",
        "sz": "ac co org",
        "tz": "ac co go hotel info me mil mobi ne or sc tv",
        "zw": "ac co gov mil org",
        "bw": "co org",
        "ls": "ac biz co edu gov info net org sc",
        "cr": "ac co ed fi go or sa",
        "gg": "co net org",
        "je": "co net org",
        "lt": "gov",
        "lu": "gov",
        "be": "ac",
        "se": "org pp tm",
        "no": "co gs mil dep kommune",
        "fi": "aland",
        "ee": "edu gov riik lib med com pri aip org fie",
        "by": "gov mil com of",
        "md": "gov",
        "mm": "com net org gov edu",
        "kh": "com net org gov edu mil per",
        "bd": "com net org gov edu mil ac",
        "sk": "gov",
        "cl": "co gob gov mil",
        "ni": "ac co gob in nom",
        "pa": "ac gob sld abo ing med nom",
        "sv": "gob red",
        "gt": "gob ind",
        "bo": "gob tv web",
        "do": "art gob sld web",
        "cy": "ac biz ltd press pro tm",
        "mt": "press",
        "lk": "ac assn grp hotel int ltd ngo sch soc web",
        "ro": "arts firm info nom nt rec store tm www",
        "ug": "ac co go ne or sc",
        "ly": "id med plc sch",
        "tn": "ens fin ind info intl mincom nat perso tourism",
    }.items()
    for second in seconds.split()
)


def part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, SPLIT, n)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def domain(url: Column) -> Column:
    """The authority as it stands."""
    return part(url, 2)


def path(url: Column) -> Column:
    return part(url, 3)


def query(url: Column) -> Column:
    return part(url, 4)


def fragment(url: Column) -> Column:
    return part(url, 5)


def _quote(text: Column, safe: str) -> Column:
    quoted = lambda ch: F.when(ch.rlike(f"^[A-Za-z0-9_.\\-{safe}]$"), ch).otherwise(F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1"))
    return F.when(text == "", text).otherwise(F.array_join(F.transform(F.split(text, ""), quoted), ""))


def quoted(url: Column) -> Column:
    """Non-ASCII URLs with path, query and fragment percent-encoded; others as they are."""
    prefix = F.concat(F.when(part(url, 1) == "", "").otherwise(F.concat(part(url, 1), F.lit(":"))), F.when(part(url, 2) == "", "").otherwise(F.concat(F.lit("//"), part(url, 2))))
    return F.when(_ascii(url), url).otherwise(_quoted_parts(prefix, path(url), query(url), fragment(url)))


def quoted_from(home: Column, path: Column, query: Column) -> Column:
    """X1 for an address that is made of parts: a mark of the next part, as the # of a word, ends no part that it stands in."""
    whole = F.concat(home, path, F.lit("?"), query)
    return F.when(_ascii(whole), whole).otherwise(_quoted_parts(home, path, query, F.lit("")))


def _ascii(text: Column) -> Column:
    return text.rlike(r"^[\x00-\x7F]*$")


def _quoted_parts(prefix: Column, path: Column, query: Column, fragment: Column) -> Column:
    whole = lambda mark, text: F.when(text == "", "").otherwise(F.concat(F.lit(mark), text))
    return F.concat(prefix, _quote(path, "/"), whole("?", _quote(query, "&?=")), whole("#", _quote(fragment, "/")))


#: Subdomain, label and public suffix of a host; the shortest subdomain that leaves both.
HOST = (
    r"^(?:(.*?)\.)??([^.]+?)(?:\.((?:" + PLAIN_SECONDS.replace(" ", "|") + r")\.(?:" + PLAIN_COUNTRIES.replace(" ", "|") + ")|" + "|".join(x.replace(".", r"\.") for x in SUFFIXES) + r"|[^.]+))?$"
)


def _host_part(host: Column, n: int) -> Column:
    name = F.lower(F.btrim(F.regexp_replace(host, r":\d*$", ""), F.lit(".")))
    return F.regexp_extract(name, HOST, n)


def suffix_of(host: Column) -> Column:
    """The public suffix of a host name."""
    return _host_part(host, 3)


def domain_without_suffix(host: Column) -> Column:
    """The label that was paid for: `bbc` of `www.bbc.co.uk`."""
    return _host_part(host, 2)


def subdomain_of(host: Column) -> Column:
    return _host_part(host, 1)


def suffix(url: Column) -> Column:
    return suffix_of(domain(url))


def subdomain(url: Column) -> Column:
    return subdomain_of(domain(url))


def pld(url: Column) -> Column:
    """The pay-level domain."""
    return F.concat(domain_without_suffix(domain(url)), F.lit("."), suffix(url))


def normalized_host(host: Column) -> Column:
    """No outer dots, no leading www., no default port."""
    bare = F.regexp_replace(F.btrim(host, F.lit(".")), r"^(?:www\.)+", "")
    return F.btrim(F.regexp_replace(bare, r":(?:80|443)$", ""), F.lit("."))


def normalized_domain(url: Column) -> Column:
    return normalized_host(domain(url))


def normalized_subdomain(url: Column) -> Column:
    """X10."""
    return F.regexp_replace(F.btrim(subdomain(url), F.lit(".")), r"^(?:www\.)+|^www$", "")


def normalized_path(url: Column) -> Column:
    """X11."""
    return F.regexp_replace(path(url), "^/$", "")


def _normal(url: Column, tail: Column) -> Column:
    # Each part is named once: an expression that names its input often grows with every nesting.
    whole = F.ltrim(F.concat(normalized_domain(url), F.regexp_replace(path(url), "^$", "/"), tail), F.lit("/"))
    return F.regexp_replace(whole, "^([^/]*)/$", "$1")


def normalized(url: Column) -> Column:
    """The key by which URLs are the same."""
    return _normal(url, F.regexp_replace(query(url), "(?s)^(.+)$", "?$1"))


def normalized_without_query(url: Column) -> Column:
    """X5."""
    return _normal(url, F.lit(""))


def homepage(url: Column) -> Column:
    """X6."""
    return F.concat(scheme(url), F.lit("://"), domain(url))


def url_words(text: Column) -> Column:
    """Lower-case words of letters and digits, the scheme left out."""
    bare = F.regexp_replace(F.lower(text), r"^.*//", "")
    return F.filter(F.split(bare, r"[^a-z0-9]+"), lambda x: x != "")


def path_words(url: Column) -> Column:
    return url_words(path(url))


def domain_words(url: Column, paid: bool = True) -> Column:
    """Words of the host; without the paid domain those of the subdomain."""
    return url_words(normalized_domain(url) if paid else normalized_subdomain(url))


def paid_words(url: Column) -> Column:
    return url_words(domain_without_suffix(domain(url)))


def all_url_words(url: Column) -> Column:
    """Domain words, then path words."""
    return F.concat(domain_words(url), path_words(url))


def filename_words(text: Column) -> Column:
    """Words of the last path segment without its extension."""
    return url_words(F.regexp_extract(F.regexp_replace(text, r"(?<=[^/.])\.[^./]*$", ""), r"([^/]*)$", 1))


def last(words: Column, n: int) -> Column:
    """The last n of an array, or all."""
    return F.when(F.size(words) > n, F.slice(words, -n, n)).otherwise(words)


def without_scheme(url: Column) -> Column:
    """X25."""
    return F.regexp_replace(url, r"^https?://", "")


def without_fragment(url: Column) -> Column:
    """X26."""
    return F.regexp_replace(url, r"#.*", "")
