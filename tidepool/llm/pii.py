"""Surrogates for personal data: keyed, type-consistent replacements, with collision checks.

Detected entities (patterns below; card numbers must pass the Luhn test, IBANs modulo 97, IP octets 255) get
replacements drawn from a keyed hash of kind and normalised value, so one value has one surrogate in all
documents and spellings (coreference), and without the key none can be traced back. Surrogates keep what
the type needs: separators, letter case, script and digits stay where they are; cards keep the first digit and a valid check
digit, IBANs country and check digits, phones the country code; secrets stay hexadecimal; e-mail domains map as a whole,
to the reserved top level ``example``; IP addresses go to the reserved block 240-254; SSNs to unassigned 9xx areas. Names
after a title get names built in the gender of the title (given names) and in the script they are written in;
each part of a name maps by itself, so "Mr. Smith" follows "Mr. John Smith". A title's dot may be missing; a part is a
capitalised or all capital word, also with an apostrophe, a hyphen or capitals inside, or an initial (which gets a whole name).

Collisions: all distinct values are drawn once; a surrogate drawn for two values, or equal to a value that
is really there, is drawn again (the smallest value keeps it) until none is left. From draw ``DRAWS`` on each draw is
one character, digit, octet or syllable longer than the one before, so there is always room, however many values a kind has.
What has been drawn again is a table of exceptions, joined to the documents only if it has rows; everything else is a
pure function of the text. The work is DataFrame expressions only, no Python in tasks.

Defined cases: null texts stay null, empty ones empty, without entities. Repeated rows get equal results.
An empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common as C

DRAWS = 4                            # draws of a value's own length; later ones grow
KEY = "tidepool-surrogates"          # production callers give their own
#: Country calling codes of one and two digits; all others have three.
COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

#: Titles that announce a name, by the gender of the given name that follows.
TITLES = {"m": ["Mr.", "Mr", "Herr", "Monsieur", "Señor", "Sir", "Господин"],
          "f": ["Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Lady", "Госпожа"],
          "u": ["Dr.", "Dr", "Prof.", "Prof"]}
_TITLE = "|".join(t.replace(".", "\\.") for ts in TITLES.values() for t in ts)
_INITIAL = r"\p{Lu}(?:\.|(?= \p{Lu}[\p{L}'’]))"
_NAME = r"(?:\p{Lu}['’])?\p{Lu}[\p{L}\p{M}]+(?:[-'’](?!S(?!\p{L}))\p{Lu}[\p{L}\p{M}]+)*"
PATTERNS = {
    "secret": r"(?i:\b(?:token|api[_-]?key|secret|password)\b\s?[=:]\s?[\"'])[A-Za-z0-9_\-]{16,128}(?=[\"'])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![\p{L}\p{N}@])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<![\d.-])(?:1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<!\d)\(0\d{2,5}\) ?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\d.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?!\d)",
    "name": rf"(?<![\p{{L}}])(?:{_TITLE}) (?:{_INITIAL} ){{0,3}}{_NAME}(?: (?:{_NAME}|{_INITIAL} {_NAME})){{0,2}}",
}
#: What a pattern can begin with: tried before the pattern itself, so most places fail on one character.
_BEGINS = {"secret": "(?=[TtAaSsPp])", "iban": "(?=[A-Z]{2}[0-9])", "phone": "(?=[0-9+(])", "card": "(?=[0-9])", "ip": "(?=[0-9])",
           "ssn": "(?=[0-9])", "name": "(?=[" + "".join(sorted({t[0] for ts in TITLES.values() for t in ts})) + "])"}
_REST = "|".join(_BEGINS[k] + "(?:" + PATTERNS[k] + ")" for k in ("secret", "iban", "phone", "card", "ip", "ssn", "name"))
#: All patterns, and all but e-mail's (for texts without an at sign).
ANY, NO_MAIL = "(?:" + PATTERNS["email"] + ")|" + _REST, _REST


def _hint(text: Column) -> Column:
    """False only for texts without any entity: each holds a digit, an at sign, a quoted value or a title."""
    titles = [F.contains(text, F.lit(t + " ")) for ts in TITLES.values() for t in ts]
    return reduce(lambda a, b: a | b, titles, text.rlike("[0-9@]") | text.rlike("[=:]\\s?[\"']"))


_LOWER, _CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя"
#: Syllables and endings that surrogate names are built from: script, then gender.
_PARTS = {"latin": ["ba", "be", "da", "do", "el", "fa", "ga", "ha", "jo", "ka", "la", "li", "ma", "mi", "na", "no", "ol", "pe", "ra", "ri", "sa", "so", "ta", "ti", "ul", "va", "vi", "wa", "ya", "ze", "bri", "tra"],
          "cyrillic": ["ба", "ве", "да", "до", "ел", "га", "жа", "за", "ка", "ла", "ли", "ма", "ми", "на", "но", "ол", "пе", "ра", "ри", "са", "со", "та", "ти", "ул", "фа", "ха", "ча", "ша", "ва", "бо", "ро", "ту"]}
_ENDS = {"latin": {"given_m": ["rd", "n", "s", "k"], "given_f": ["a", "ia", "ina", "elle"], "given_u": ["ey", "in", "is", "e"], "surname": ["son", "ler", "mann", "ez"]},
         "cyrillic": {"given_m": ["н", "р", "й", "м"], "given_f": ["а", "ия", "ина", "я"], "given_u": ["я", "а", "й", "н"], "surname": ["енко", "ских", "ич", "ян"]}}


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(stream: Column, at) -> Column:
    """Number 0..255 at a place of the keyed stream."""
    return F.conv(F.substring(stream, F.lit(2) * (at % 256) + 1, F.lit(2)), 16, 10).cast("int")


def _stream(key: str, kind: Column, norm: Column, draw: Column) -> Column:
    """512 hex digits that only the key's holder can make."""
    said = F.concat_ws("|", kind, norm, draw.cast("string"))
    seed = F.sha2(F.concat(F.lit(key), F.sha2(F.concat(F.lit(key + "|"), said), 256)), 256)
    return F.concat(*[F.sha2(F.concat(seed, F.lit(str(i))), 512) for i in range(4)])


def _pick(text: str, at: Column) -> Column:
    return F.substring(F.lit(text), at % len(text) + 1, F.lit(1))


def _like(c: Column, v: Column, hexadecimal) -> Column:
    """A character of the same class, case and script."""
    low = F.lower(c)
    upper = (c != low)
    letter = (F.when(hexadecimal, _pick("abcdef", v)).when(c.rlike(r"\p{IsCyrillic}"), _pick(_CYRILLIC, v)).otherwise(_pick(_LOWER, v)))
    return F.when(c.rlike("[0-9]"), (v % 10).cast("string")).when(c.rlike(r"\p{L}"), F.when(upper, F.upper(letter)).otherwise(letter)).otherwise(c)


def _shaped(text: Column, stream: Column, hexadecimal=None) -> Column:
    """The text with every letter and digit exchanged; the n-th of them depends on n, not on separators."""
    plain = F.lit(False) if hexadecimal is None else hexadecimal
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    def step(acc, c):
        return F.struct(F.concat(acc["out"], _like(c, _number(stream, acc["n"]), plain)).alias("out"),
                        (acc["n"] + F.when(c.rlike(r"[\p{L}0-9]"), 1).otherwise(0)).alias("n"))
    return F.aggregate(F.split(text, ""), start, step, lambda acc: acc["out"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _phone_norm(text: Column) -> Column:
    """Digits, after a plus sign if the country code is written (a leading 1 of eleven digits is one)."""
    long = text.rlike(r"^1[ .(-]") & (F.length(_digits(text)) == 11)
    return F.concat(F.when(text.startswith("+") | long, "+").otherwise(""), _digits(text))


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one is not doubled."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("twice"))
    def step(acc, c):
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.struct((acc["sum"] + F.when(acc["twice"], twice).otherwise(d)).alias("sum"), (~acc["twice"]).alias("twice"))
    return F.aggregate(F.split(F.reverse(digits), ""), start, step, lambda acc: acc["sum"])


def _mod97(text: Column) -> Column:
    """Value modulo 97 of digits and capital letters (A = 10 ...)."""
    def step(acc, c):
        return F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _kind(m: Column) -> Column:
    """Kind of a match; null if it turns out to be none."""
    solid = F.regexp_replace(m, " ", "")
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    iban = _mod97(F.concat(F.substring(solid, F.lit(5), F.length(solid)), F.substring(solid, F.lit(1), F.lit(4)))) == 1
    return (F.when(m.rlike("@"), "email").when(m.rlike("[=:]\\s?[\"']"), "secret")
            .when(m.rlike(r"^[A-Z]{2}\d{2}"), F.when(iban, "iban"))
            .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.when(F.array_max(octets) < 256, "ip"))
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^[+(]|^(1[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}$"), "phone")
            .when(m.rlike(r"^\d[\d -]*$"), F.when(_luhn_sum(_digits(m)) % 10 == 0, "card"))
            .otherwise("name"))


def _value(m: Column) -> Column:
    """The secret's value, without the words before it."""
    return F.regexp_extract(m, r"([A-Za-z0-9_\-]{16,128})$", 1)


def _gender(m: Column) -> Column:
    out = F.lit("given_u")
    for g in ("m", "f"):
        out = F.when(reduce(lambda a, b: a | b, [m.startswith(t + " ") for t in TITLES[g]]), f"given_{g}").otherwise(out)
    return out


def _parts(kind: Column, m: Column) -> Column:
    """(kind, norm) of what is replaced in a match: one, or each part of a name."""
    tokens = F.slice(F.split(m, " "), 2, 12)
    names = F.transform(tokens, lambda t, i: F.struct(
        F.when(i == F.size(tokens) - 1, "surname").otherwise(_gender(m)).alias("kind"), F.translate(F.lower(t), "’.", "'").alias("norm")))
    norm = (F.when(kind.isin("email"), F.lower(m)).when(kind == "secret", _value(m))
            .when(kind == "phone", _phone_norm(m)).when(kind.isin("card", "ssn"), _digits(m)).when(kind == "iban", F.regexp_replace(m, " ", "")).otherwise(m))
    return F.when(kind == "name", names).otherwise(F.array(F.struct(kind.alias("kind"), norm.alias("norm"))))


def _name(kind: Column, written: Column, stream: Column, more: Column) -> Column:
    """A name in the script of ``written``, in the gender of ``kind``, with ``more`` syllables than usual."""
    def built(script: str) -> Column:
        parts = _array(_PARTS[script])
        body = F.concat(*[F.element_at(parts, _number(stream, F.lit(i)) % 32 + 1) for i in range(3)])
        grown = F.transform(F.sequence(F.lit(1), more), lambda i: F.element_at(parts, _number(stream, i + 5) % 32 + 1))
        body = F.when(more > 0, F.concat(body, F.array_join(grown, ""))).otherwise(body)
        end = F.lit("")
        for k, ends in _ENDS[script].items():
            end = F.when(kind == k, F.element_at(_array(ends), _number(stream, F.lit(5)) % 4 + 1)).otherwise(end)
        return F.initcap(F.concat(body, end))
    name = F.when(written.rlike(r"\p{IsCyrillic}"), built("cyrillic")).otherwise(built("latin"))
    return F.when(written.rlike(r"\p{Lu}{2}") & (written == F.upper(written)), F.upper(name)).otherwise(name)


def surrogate(key: str, kind: Column, written: Column, norm: Column, draw: Column) -> Column:
    """Replacement of one part as it is written; equal for equal norms up to separators and case."""
    more = F.greatest(draw - DRAWS + 1, F.lit(0))
    return let(F.struct(kind.alias("kind"), _grown(kind, written, more).alias("written"), norm.alias("norm"), _stream(key, kind, norm, draw).alias("s"),
                        more.alias("more"), (written == F.upper(written)).alias("upper")),
               lambda x: _surrogate(key, x["kind"], x["written"], x["norm"], x["s"], x["more"], x["upper"]))


def _grown(kind: Column, written: Column, more: Column) -> Column:
    """The value with ``more`` further places, which are drawn like its own."""
    at = F.instr(written, "@")
    email = F.concat(F.substring(written, F.lit(1), at - 1), F.repeat(F.lit("a"), more), F.substring(written, at, F.length(written)))
    longer = F.when(kind == "email", email).when(kind == "secret", F.concat(written, F.repeat(F.lit("a"), more))).when(
        kind.isin("card", "ssn", "phone", "iban"), F.concat(written, F.repeat(F.lit("0"), more))).otherwise(written)
    return F.when(more > 0, longer).otherwise(written)


def _surrogate(key: str, kind: Column, written: Column, norm: Column, s: Column, more: Column, upper: Column) -> Column:
    at = F.instr(written, "@")
    domain = F.lower(F.substring(written, at + 1, F.length(written)))
    host = F.regexp_replace(domain, r"\.[^.]*$", "")
    local = _shaped(F.substring(written, F.lit(1), at - 1), s)
    place = let(F.struct(host.alias("host"), _stream(key, F.lit("domain"), domain, F.lit(0)).alias("s")), lambda x: _shaped(x["host"], x["s"]))
    email = F.concat(local, F.lit("@"), place, F.lit(".example"))
    email = F.when(upper, F.upper(email)).otherwise(email)
    value = _value(written)
    secret = F.concat(F.substring(written, F.lit(1), F.length(written) - F.length(value)), _shaped(value, s, F.lower(value).rlike("^[0-9a-f]+$")))
    octet = [_number(s, F.lit(i)) for i in range(4)]
    ip = F.concat_ws(".", (240 + octet[0] % 15).cast("string"), *[o.cast("string") for o in octet[1:]])
    ip = F.when(more > 0, F.concat_ws(".", ip, F.transform(F.sequence(F.lit(1), more), lambda i: _number(s, i + 3).cast("string")))).otherwise(ip)
    body = F.concat(F.substring(written, F.lit(1), F.lit(1)), F.substring(_shaped(written, s), F.lit(2), F.length(written) - 2))
    card = let(body, lambda b: F.concat(b, ((10 - _luhn_sum(F.concat(_digits(b), F.lit("0"))) % 10) % 10).cast("string")))
    ssn = F.concat(F.lit("9"), F.substring(_shaped(written, s), F.lit(2), F.length(written)))
    # the norm says how many digits are the country code, so all spellings keep the same ones
    n = F.length(F.regexp_extract(norm, COUNTRY, 1))
    code = F.lit("")
    for i in (1, 2, 3):
        code = F.when(n == i, F.regexp_extract(written, rf"^(\D*(?:\d\D*){{{i - 1}}}\d)", 1)).otherwise(code)
    phone = F.concat(code, _shaped(F.substring(written, F.length(code) + 1, F.length(written)), s))
    solid = F.regexp_replace(norm, " ", "")
    bban = _shaped(F.substring(written, F.lit(5), F.length(written)), s)
    country = F.substring(solid, F.lit(1), F.lit(2))
    iban = let(bban, lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(F.regexp_replace(b, " ", ""), country, F.lit("00")))).cast("string"), 2, "0"), b))
    return (F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "ip", ip).when(kind == "card", card)
            .when(kind == "ssn", ssn).when(kind == "phone", phone).when(kind == "iban", iban).otherwise(_name(kind, written, s, more)))


def _norm_of(kind: Column, text: Column) -> Column:
    return F.element_at(_parts(kind, text), 1)["norm"]


def _written(kind: Column, norm: Column) -> Column:
    """A value to draw on for the collision check: its norm, in a form that ``surrogate`` reads."""
    return F.when(kind == "secret", F.concat(F.lit("token=\""), norm)).otherwise(norm)


def exceptions(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, draw) of the values that must be drawn again, from the distinct (kind, norm)."""
    def drawn(rows: DataFrame) -> DataFrame:
        text = surrogate(key, F.col("kind"), _written(F.col("kind"), F.col("norm")), F.col("norm"), F.col("draw"))
        is_name = F.col("kind").startswith("given") | (F.col("kind") == "surname")
        got = F.when(is_name, F.lower(text)).when(F.col("kind") == "secret", _value(text)).when(F.col("kind") == "email", F.lower(text)).when(
            F.col("kind").isin("card", "ssn"), _digits(text)).when(F.col("kind") == "phone", _phone_norm(text)).otherwise(text)
        # given names are one space, whatever their gender
        space = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind"))
        return rows.withColumns({"got": got, "space": space})

    real = entities.select(F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind")).alias("space"), F.col("norm").alias("got")).distinct()
    table = C.settle(drawn(entities.withColumn("draw", F.lit(0))))
    for draw in itertools.count(1):
        keeper = table.groupBy("space", "got").agg(F.min(F.struct("draw", "norm", "kind")).alias("keeper"), F.count("*").alias("n"))
        shared = table.join(keeper.filter("n > 1"), ["space", "got"]).filter(
            (F.struct("draw", "norm", "kind") != F.col("keeper"))).select("kind", "norm")
        taken = table.join(real, ["space", "got"], "left_semi").select("kind", "norm")
        again = C.settle(shared.union(taken).distinct())
        if again.isEmpty():
            break
        fresh = drawn(again.withColumn("draw", F.lit(draw)))
        table = C.settle(table.join(again, ["kind", "norm"], "left_anti").unionByName(fresh.select(*table.columns)))
    return table.filter("draw > 0").select("kind", "norm", "draw")


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per input row: doc_id, n_entities, text with surrogates."""
    def by_mail(what):
        return F.when(F.contains(F.col("text"), F.lit("@")), what(ANY)).otherwise(what(NO_MAIL))

    found = by_mail(lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0)))
    rows = C.doc_texts(docs).withColumn("found", F.when(_hint(F.col("text")), found).otherwise(
        F.when(F.col("text").isNotNull(), F.array().cast("array<string>"))))
    matched = rows.filter(F.size("found") > 0).select("doc_id", "text", F.transform(
        "found", lambda m: F.struct(m.alias("m"), _kind(m).alias("kind"))).alias("found"))
    parts = F.explode(F.flatten(F.transform(F.filter("found", lambda x: x["kind"].isNotNull()), lambda x: _parts(x["kind"], x["m"])))).alias("part")
    entities = C.settle(matched.select(parts).select("part.kind", "part.norm").distinct())
    odd = exceptions(entities, key)
    gaps = by_mail(lambda p: F.split("text", p, -1))
    kinds = F.transform("found", lambda m: _kind(m))
    base = rows.withColumn("kinds", F.when(F.size("found") > 0, kinds))
    again = None
    if not odd.isEmpty():
        each = matched.select("doc_id", F.xxhash64("text").alias("mark"), parts).select("doc_id", "mark", "part.kind", "part.norm").distinct()
        again = each.join(odd, ["kind", "norm"]).groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("k")).agg(
            F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "norm"), "draw"))).alias("draws"))
        base = base.join(again, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("k")), "left")

    def draw_of(part: Column) -> Column:
        if again is None:
            return F.lit(0)
        return F.coalesce(F.element_at(F.col("draws"), F.concat_ws("|", part["kind"], part["norm"])), F.lit(0))

    def replaced(m: Column, kind: Column) -> Column:
        # a name is its title and its parts; anything else is one part
        written = F.when(kind == "name", F.slice(F.split(m, " "), 2, 12)).otherwise(F.array(m))
        parts = F.transform(F.arrays_zip(_parts(kind, m).alias("part"), written.alias("written")),
                            lambda x: surrogate(key, x["part"]["kind"], x["written"], x["part"]["norm"], draw_of(x["part"])))
        title = F.when(kind == "name", F.concat(F.element_at(F.split(m, " "), 1), F.lit(" "))).otherwise("")
        return F.when(kind.isNull(), m).otherwise(F.concat(title, F.array_join(parts, " ")))

    pieces = F.transform(F.arrays_zip(gaps.alias("gap"), F.col("found"), F.col("kinds")), lambda x: F.concat(
        F.coalesce(x["gap"], F.lit("")), F.when(x["found"].isNotNull(), replaced(x["found"], x["kinds"])).otherwise(F.lit(""))))
    text = F.when(F.size("found") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    n = F.coalesce(F.size(F.filter("kinds", lambda k: k.isNotNull())), F.lit(0))
    return base.select("doc_id", F.when(F.col("kinds").isNull(), 0).otherwise(n).cast("long").alias("n_entities"), text.alias("text"))
