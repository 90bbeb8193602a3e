"""Column expressions over untrusted text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(c: Column) -> Column:
    """Never null, so that a negated match keeps the row."""
    return F.coalesce(c.cast("string"), F.lit(""))


def tokens_pattern(tokens: Iterable[str]) -> str:
    """A pattern, the same in Java and RE2, for any of the tokens between other than ASCII letters and digits."""
    return f"(^|[^a-z0-9])({'|'.join(re.escape(t) for t in tokens)})([^a-z0-9]|$)"


def mentions(c: Column, tokens: Iterable[str]) -> Column:
    own = list(tokens)
    return F.lower(text(c)).rlike(tokens_pattern(own)) if own else F.lit(False)


def words_of(terms: Iterable[str]) -> dict[str, list[str]]:
    """Each term and the words that it is made of."""
    return {t: [w for w in re.split("[^a-z0-9]+", t) if w] for t in dict.fromkeys(terms)}


def known_words(c: Column, terms: Iterable[str]) -> Column:
    """The words of the terms that a text has: it is split once, and its words are looked up in the dictionary of them."""
    own = sorted({w for words in words_of(terms).values() for w in words})
    if not own:
        return F.array().cast("array<string>")
    return F.array_intersect(F.split(F.lower(text(c)), "[^a-z0-9]+"), F.lit(own))


def terms_in(c: Column, terms: Iterable[str], words: Column | None = None) -> Column:
    """The distinct terms that ``mentions`` finds one by one, as an array.

    words: ``known_words`` of the text, if they are known already.  A term of one word is among them or isn't there; one of several
    words, or with other characters, is looked for in the few texts that have all its words.
    """
    own = words_of(terms)
    if not own:
        return F.array().cast("array<string>")
    if words is None:  # as a variable the text is split once, and not again for every term of several words
        return F.get(F.transform(F.array(known_words(c, own)), lambda w: _terms_among(c, own, w)), F.lit(0))
    return _terms_among(c, own, words)


def _terms_among(c: Column, own: dict[str, list[str]], words: Column) -> Column:
    single = [t for t, parts in own.items() if [t] == parts]
    found = F.array_intersect(words, F.lit(single)) if single else F.array().cast("array<string>")
    hits = []
    for term, parts in own.items():
        if term not in single:
            all_of = F.size(F.array_intersect(words, F.lit(parts))) == len(set(parts)) if parts else F.lit(True)
            hits.append(F.when(all_of, F.when(mentions(c, [term]), term)))
    return F.concat(found, F.array_compact(F.array(*hits))) if hits else found


# Numbers in words, the words of years, bounds from above, and what makes a number of years an age.
NUMBERS = {w: n for n, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve".split())} | {"fifteen": 15, "twenty": 20}
YEAR_WORDS = ("years", "year", "yrs", "yr")
AT_MOST = ("up to", "less than", "fewer than", "no more than", "at most", "under", "below", "within", "maximum of", "max")
AGES = ("for", "over", "past", "last", "than")
_NUMBER = rf"(?:[0-9]{{1,2}}|{'|'.join(NUMBERS)})"
_MENTION = rf"(?:({'|'.join(AT_MOST)})\s+)?({_NUMBER})(?:\.[0-9])?\s*\+?\s*(?:\([0-9]{{1,2}}\+?\)\s*)?(?:(?:[-–—]|to|or)\s*({_NUMBER})\s*)?\+?(?:or more\s*)?\s*(?:{'|'.join(YEAR_WORDS)})(?:[^a-z0-9]|$)"
MENTION = rf"(?:^|[^a-z0-9.]){_MENTION}"
_AGED = rf"(?:^|[^a-z])(?:{'|'.join(AGES)})\s+(?:the\s+)?(?:past\s+|last\s+|more\s+than\s+|about\s+|nearly\s+)?{_MENTION}"


def _number(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in NUMBERS.items() for x in kv])
    return F.coalesce(c.try_cast("int"), F.try_element_at(table, c))


def _interval(mention: Column) -> Column:
    """(least, most) of a mention: "up to n" begins at 0, a plain n and "n or more" have no most."""
    bound, low, high = (F.regexp_extract(mention, MENTION, k) for k in (1, 2, 3))
    least, most = _number(low), _number(high)
    return F.when(mention.isNotNull(), F.struct(F.when(bound != "", 0).otherwise(least).alias("least"), F.when(bound != "", F.coalesce(most, least)).otherwise(most).alias("most")))


def years_asked(c: Column) -> Column:
    """(least, most) years that a text asks for, null if it names none; most is null where it isn't bounded.

    A text falls into clauses at full stops before white space, semicolons and line ends.  The first clause that names both
    years and experience decides, by the last number of years in front of that word, else by the first behind it,
    whatever is around it ("over 3 years of experience").  Without such a clause the first number of years counts
    that isn't an age ("for 30 years we have").  Numbers are digits or words up to twelve, fifteen and twenty.
    """
    lower, place = F.lower(text(c)), F.lit(0)
    every = lambda x: F.regexp_extract_all(x, F.lit(MENTION), place)
    before = lambda x: F.try_element_at(every(F.regexp_extract(x, "(?s)^(.*?)experience", 1)), F.lit(-1))
    behind = lambda x: F.get(every(F.regexp_extract(x, "(?s)experience(.*)$", 1)), place)

    def first(clauses: Column) -> Column:
        near = F.filter(F.transform(clauses, lambda x: F.when(x.contains("experience"), F.coalesce(before(x), behind(x)))), lambda x: x.isNotNull())
        plain = F.filter(F.transform(clauses, lambda x: F.get(every(F.regexp_replace(x, _AGED, " ")), place)), lambda x: x.isNotNull())
        return F.coalesce(F.get(near, place), F.get(plain, place))

    # as variables the clauses and the mention are found once, and not again for every part of the interval
    once = lambda x, of: F.get(F.transform(F.array(x), of), place)
    clauses = F.filter(F.split(lower, r"[;\n]+|\.(?:\s+|$)"), lambda x: x.contains("year") | x.contains("yr"))
    return F.when(lower.contains("year") | lower.contains("yr"), once(once(clauses, first), _interval))


def least_years(c: Column) -> Column:
    return years_asked(c)["least"]


def canonical_url(c: Column) -> Column:
    """Lower case, without scheme, www. or m., query, fragment and last slash; null for null or blank."""
    bare = F.regexp_replace(F.trim(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"[?#].*$", ""), r"^([wW]{3}|[mM])\.", "")
    return F.nullif(F.regexp_replace(F.lower(bare), r"/+$", ""), F.lit(""))


def host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z]+://([^/:?#]+)", 1))


# Parameters that tell where a reader came from, and not which page it is.
TRACKING = ("utm", "utm_[a-z]+", "gclid", "fbclid", "msclkid", "ref", "referrer", "src", "gh_src", "trk", "trackingid")


def url_key(c: Column) -> Column:
    """The page that a URL names: ``canonical_url`` with its query, but for parameters of tracking and in the order of their
    names, and with its fragment where that is a path ("#/job/3")."""
    own = F.trim(text(c))
    query = F.lower(F.regexp_extract(own, r"^[^?#]*\?([^#]*)", 1))
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.regexp_like(x, F.lit(f"^(?:{'|'.join(TRACKING)})(?:=|$)"))))
    route = F.lower(F.regexp_extract(own, "#(!?/.*)$", 1))
    tail = F.concat(F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""), F.when(route != "", F.concat(F.lit("#"), route)).otherwise(""))
    return F.concat(canonical_url(c), tail)


def job_id(source: Column, native_id: Column, url: Column) -> Column:
    """The identity of a job within its source: source and native id, or source and page; without either the plan fails."""
    key = F.coalesce(F.nullif(F.trim(native_id), F.lit("")), url_key(url))
    return F.when(key.isNull() | source.isNull(), F.raise_error(F.lit("a listing needs a source, and a native id or a URL"))).otherwise(F.md5(F.concat_ws("|", source, key)))


def markdown(c: Column) -> Column:
    """Untrusted text as literal Markdown on one line."""
    flat = F.regexp_replace(text(c), r"[\r\n]+", " ")
    return F.regexp_replace(flat, r"([\\`*_{}\[\]()#+!|<>~-])", r"\\$1")
