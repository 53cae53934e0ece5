"""Surrogates for personal data, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, table
from tickloom.session import written

# The session names the key of a mapping that others must not rebuild; without one the
# mapping is that of this public default.
KEY_SETTING = "spark.tickloom.surrogateKey"
KEY = "surrogates-v1"

_SECRET = r"(?i:password|passwd|secret|api[_-]?key|token)\s{0,2}[=:]\s{0,2}[\"']?"
_MALE = "Mr|MR|Herr|HERR|Señor|Monsieur|Г-н|г-н"
_FEMALE = "Mrs|MRS|Ms|Miss|MISS|Frau|FRAU|Señora|Madame|Mme|Г-жа|г-жа"
_OPEN = "Dr|DR|Prof|PROF"
_GAP = r"[\s ]"
_TITLE = f"(?:{_MALE}|{_FEMALE}|{_OPEN})\\.?{_GAP}{{1,3}}+"
_PARTICLE = "(?:van|von|der|den|de|del|della|di|da|dos|la|le|zu|ter|ten|bin|ibn|al|el)"
_PART = r"(?:\p{Lu}\.(?=[  ]{1,3}\p{Lu})|\p{Lu}[\p{L}\p{M}]*+(?:['’-](?!s(?![\p{L}\p{M}]))[\p{L}\p{M}]++)*+)"
_SPACE = r"[  ]{1,3}+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEXES = "[0-9A-Fa-f]{1,4}"
# One alternative for each kind. None can be tried again and again over one long run of
# characters: runs are taken whole, or looked at from their start only.
PATTERNS = {
    "secret": "(?=[pastPAST])" + _SECRET + r"[^\s\"'<>]{6,}+",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "aws_key": r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "hex_key": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{_HEXES}:){{7}}{_HEXES}|(?=[0-9A-Fa-f]{{4}}:)(?:{_HEXES}:){{1,6}}(?::{_HEXES}){{1,6}})(?![\p{{L}}\p{{N}}:])",
    "card": r"(?<![\d.])(?:\d{4}(?:[ -]?\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)",
    "ipv4": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d)(?!\.\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}]){_TITLE}{_PART}(?:(?:{_SPACE}{_PARTICLE}){{0,3}}{_SPACE}(?!{_TITLE}){_PART})*+",
}
# What a kind begins with is looked at first, so that most places of a text are passed in one step.
_FIRST = {
    "email": r"(?=[\p{L}\p{N}._%+-])", "aws_key": "(?=A)", "hex_key": "(?=[0-9A-Fa-f])", "iban": "(?=[A-Z]{2})",
    "ipv6": "(?=[0-9A-Fa-f])", "card": r"(?=\d)", "ssn": r"(?=\d)", "phone": r"(?=[\d+(])", "ipv4": r"(?=\d)",
    "name": "(?=[MHSFDPГг])",
}
ENTITY = "|".join(f"(?:{_FIRST.get(kind, '')}{p})" for kind, p in PATTERNS.items())
# Without an at sign, a digit or two colons only these kinds can be in a text.
_BARE_START = f"(?=[pastPAST]){_SECRET}|[a-f]{{32}}|[A-F]{{32}}|(?=[MHSFDPГг])(?<![\\p{{L}}\\p{{N}}]){_TITLE}"

# Given names by kind, fixed; surnames and further names are made of syllables.
GIVEN = {
    "given_male": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nico Oscar Paul Rafael Simon Tomas Viktor".split(),
    "given_female": "Alice Berta Clara Diana Emma Flora Greta Helena Irene Julia Karin Laura Marta Nora Olivia Paula Rosa Sara Teresa Vera".split(),
    "given_open": "Alex Charlie Dominique Kim Robin Sascha Toni Jules Noa Sam".split(),
}
_LATIN = "ba be di do fa go ha jo ka le li mo na no pe ra ri sa so ta te va vi zo".split()
_CYRILLIC = "ба ве ди до за ка ле ли мо на но пе ра ри са со та те фи хо".split()
_GREEK = "βα γε δι κα λο μα νι πα ρο σα τα φι".split()

# Letters of a script, or of a case of it, that stand in a row: first code point and how many.
# A letter is replaced by one of the first line that it fits; all others become Latin ones.
LETTERS = {
    r"^(?=\p{Lu})\p{IsCyrillic}": (0x410, 32),
    r"^(?=\p{L})\p{IsCyrillic}": (0x430, 32),
    r"^(?=\p{Lu})\p{IsGreek}": (0x393, 15),
    r"^(?=\p{L})\p{IsGreek}": (0x3B1, 17),
    r"^(?=\p{L})\p{IsArabic}": (0x62D, 14),
    r"^(?=\p{L})\p{IsHebrew}": (0x5D0, 27),
    r"^(?=\p{L})\p{IsDevanagari}": (0x915, 37),
    r"^(?=\p{L})\p{IsThai}": (0xE01, 46),
    r"^(?=\p{L})\p{IsHangul}": (0xAC00, 11172),
    r"^(?=\p{L})\p{IsHiragana}": (0x304B, 40),
    r"^(?=\p{L})\p{IsKatakana}": (0x30AB, 40),
    r"^(?=\p{L})\p{IsHan}": (0x4E00, 2000),
    r"^\p{Lu}": (0x41, 26),
    r"^\p{L}": (0x61, 26),
}


def may_hold(text: Column) -> Column:
    """Whether a text can hold an entity, by cheap tests: true for every text that does."""
    marks = [text.contains(mark) for mark in ("@", "::", "AKIA")]
    return marks[0] | marks[1] | marks[2] | text.rlike("[0-9]") | text.rlike(_BARE_START)


def kind_of(raw: Column) -> Column:
    """The kind of a found entity, from its form."""
    return (
        F.when(raw.rlike("^" + _SECRET), "secret")
        .when(raw.contains("@"), "email")
        .when(raw.rlike("^AKIA[0-9A-Z]{16}$"), "aws_key")
        .when(raw.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), "hex_key")
        .when(raw.contains(":") & raw.rlike("^[0-9A-Fa-f:]+$"), "ipv6")
        .when(raw.rlike(r"^[A-Z]{2}\d{2}"), "iban")
        .when(raw.rlike(r"^\p{L}"), "name")
        .when(raw.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ipv4")
        .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(raw.rlike(r"^\d{4}"), "card")
        .otherwise("phone")
    )


def _parts_of_name(raw: Column) -> Column:
    """The given names, if there are more words than one, and a surname, each with its kind."""
    words = _words(raw)
    gender = (
        F.when(raw.rlike(f"^(?:{_FEMALE})\\.?{_GAP}"), "given_female")
        .when(raw.rlike(f"^(?:{_MALE})\\.?{_GAP}"), "given_male")
        .otherwise("given_open")
    )
    script = lambda w: F.when(w.rlike(r"^\p{IsCyrillic}"), "_cyrillic").when(w.rlike(r"^\p{IsGreek}"), "_greek").otherwise("")
    part = lambda kind, w: F.struct(F.concat(kind, script(w)).alias("kind"), F.lower(w).alias("norm"))
    given = F.transform(F.slice(words, F.lit(1), F.size(words) - 1), lambda w: part(gender, w))
    return F.concat(given, F.array(part(F.lit("surname"), F.element_at(words, -1))))


def _untitled(raw: Column) -> Column:
    return F.regexp_replace(raw, f"^[^\\s\\u00A0]+{_GAP}+", "")


def _words(raw: Column) -> Column:
    """The words of a titled name that are replaced: all but the title and particles."""
    return F.filter(F.split(_untitled(raw), f"{_GAP}+"), lambda w: ~w.rlike(r"^\p{Ll}"))


def _renamed(text: Column, found: Column) -> Column:
    """A name with each word that is no particle replaced, written as that word was: in capitals,
    as an initial, or as it is drawn. Gaps and particles stay."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))

    def step(acc: Column, w: Column) -> Column:
        is_word = w.rlike(r"^(?!\p{Ll})[^\s ]")
        new = F.get(found, acc["i"])
        new = F.when(w.rlike(r"^.\.$"), F.concat(F.substring(new, 1, 1), F.lit("."))).when(
            (F.length(w) > 1) & (w == F.upper(w)), F.upper(new)
        ).otherwise(new)
        return F.struct(
            F.concat(acc["out"], F.when(is_word, new).otherwise(w)).alias("out"), (acc["i"] + is_word.cast("int")).alias("i")
        )

    pieces = F.regexp_extract_all(text, F.lit(r"[\s ]+|[^\s ]+"), F.lit(0))
    return F.aggregate(pieces, start, step)["out"]


def _bare(raw: Column) -> list[Column]:
    """A titled name without its title, and the surname alone, as written, in capitals, and with
    the first letter of each word as a capital if it stands in capitals."""
    full = _untitled(raw)
    last = F.element_at(_words(raw), -1)
    usual = lambda n: F.when(n == F.upper(n), F.initcap(n)).otherwise(n)
    return [full, last, F.upper(full), F.upper(last), usual(full), usual(last)]


def with_bare_names(ents: Column) -> Column:
    """A pattern for the entities and for the full names and surnames among them, without titles.

    Longer names come first. Single letters stand for too much, and what may begin a secret or
    an address is left to those.
    """
    names = F.filter(ents, lambda e: kind_of(e) == "name")
    bare = F.flatten(F.transform(names, lambda e: F.array(*_bare(e))))
    bare = F.filter(F.array_distinct(bare), lambda n: (F.length(n) > 1) & ~n.rlike("(?i:password|passwd|secret|api[_-]?key|token)$"))
    longest = F.transform(
        F.array_sort(F.transform(bare, lambda n: F.struct((-F.length(n)).alias("k"), n.alias("n")))),
        lambda x: F.concat(F.lit("\\Q"), x["n"], F.lit("\\E")),
    )
    whole = F.concat(
        F.lit(ENTITY + r"|(?<![\p{L}\p{M}\p{N}])(?=\p{Lu})(?:"),
        F.array_join(longest, "|"),
        F.lit(r")(?![\p{L}\p{M}\p{N}])(?![\p{L}\p{N}._%+-]*+@)"),
    )
    return F.when(F.size(bare) > 0, whole).otherwise(F.lit(ENTITY))


def parts_of(raw: Column, kind: Column) -> Column:
    """What of an entity is replaced: an array of kind and normal form, the same for all ways
    of writing the same thing (letter case of addresses, marks between digits, titles)."""
    norm = (
        F.when(kind == "secret", F.regexp_replace(raw, "^" + _SECRET, ""))
        .when(kind == "email", F.lower(raw))
        .when(kind == "phone", F.regexp_replace(raw, r"[^0-9+]", ""))
        .when(kind.isin("card", "ssn"), F.regexp_replace(raw, r"[^0-9]", ""))
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when(kind.isin("hex_key", "ipv6"), F.lower(raw))
        .otherwise(raw)
    )
    one = F.array(F.struct(kind.alias("kind"), norm.alias("norm")))
    return F.when(kind == "name", _parts_of_name(raw)).otherwise(one)


def _draw(seed: Column, at: Column, n: int) -> Column:
    """A number below n from a keyed digest of the seed and a place."""
    digest = F.sha2(F.concat_ws("|", seed, at.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(n))


def _alike(text: Column, seed: Column) -> Column:
    """Every letter and digit replaced by one of its case and script; marks stay."""

    def one(c: Column, i: Column) -> Column:
        new = F.when(c.rlike("^[0-9]"), _draw(seed, i, 10).cast("string"))
        for form, (first, n) in LETTERS.items():
            code = F.lpad(F.hex(_draw(seed, i, n) + first), 4, "0")
            new = new.when(c.rlike(form), F.decode(F.unhex(code), "UTF-16BE"))
        return new.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn_digit(digits: Column) -> Column:
    """The check digit that completes a card number."""
    rev = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    doubled = lambda c, i: F.when(i % 2 == 0, F.lit(2) * c.cast("int")).otherwise(c.cast("int"))
    folded = F.transform(F.transform(rev, doubled), lambda v: F.when(v > 9, v - 9).otherwise(v))
    total = F.aggregate(folded, F.lit(0), lambda a, v: a + v)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _iban_digits(country: Column, account: Column) -> Column:
    """The two check digits that complete an account number: 98 less the rest by 97."""
    code = lambda c: F.ascii(c) - F.when(c.rlike("^[0-9]"), 48).otherwise(55)
    step = lambda a, c: (a * F.when(c.rlike("^[0-9]"), 10).otherwise(100) + code(c)) % 97
    signs = F.filter(F.split(F.concat(account, country, F.lit("00")), ""), lambda c: c != "")
    return F.lpad((98 - F.aggregate(signs, F.lit(0), step)).cast("string"), 2, "0")


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """A replacement of the same kind and form, drawn from a keyed digest."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), norm), 256)
    rest = lambda n: F.concat(F.substring(norm, 1, n), _alike(norm.substr(F.lit(n + 1), F.length(norm)), seed))
    syllables = lambda words, n: F.array_join(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.element_at(F.lit(words), (_draw(seed, i, len(words)) + 1).cast("int")),
        ),
        "",
    )
    more = F.floor(attempt / 3).cast("int")  # names grow longer when the short ones are taken
    coined = lambda words: F.initcap(syllables(words, more + 3))
    name = F.when(kind.contains("_cyrillic"), coined(_CYRILLIC)).when(kind.contains("_greek"), coined(_GREEK))
    for which, listed in GIVEN.items():
        chosen = F.element_at(F.lit(listed), (_draw(seed, F.lit(0), len(listed)) + 1).cast("int"))
        name = name.when(kind == which, F.when(more == 0, chosen).otherwise(F.concat(chosen, syllables(_LATIN, more))))
    card = F.concat(F.substring(norm, 1, 1), _alike(norm.substr(F.lit(2), F.length(norm) - 2), seed))
    local = F.substring_index(norm, "@", 1)
    octets = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: _draw(seed, i, 256).cast("string"))
    hexes = F.transform(
        F.split(norm, ""), lambda c, i: F.when(c.rlike("^[0-9a-f]"), F.lower(F.hex(_draw(seed, i, 16)))).otherwise(c)
    )
    account = _alike(norm.substr(F.lit(5), F.length(norm)), seed)
    country = F.substring(norm, 1, 2)
    return (
        F.when(kind == "email", F.concat(_alike(local, seed), F.lit("@"), _alike(F.lit("domains"), F.reverse(seed)), F.lit(".example")))
        .when(kind == "aws_key", rest(4))
        .when(kind.isin("hex_key", "ipv6"), F.array_join(hexes, ""))
        .when(kind == "iban", F.concat(country, _iban_digits(country, account), account))
        .when(kind == "card", F.concat(card, _luhn_digit(card)))
        .when(kind == "phone", F.when(norm.startswith("+1"), rest(2)).when(norm.startswith("+"), rest(3)).otherwise(rest(0)))
        .when(kind == "ipv4", F.array_join(octets, "."))
        .when(kind == "surname", coined(_LATIN))
        .when(kind.startswith("given") | kind.startswith("surname"), name)
        .otherwise(_alike(norm, seed))
    )


def _filled(raw: Column, signs: Column, which: str) -> Column:
    """The signs of an entity that ``which`` matches, replaced one by one, with the marks between them."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))

    def step(acc: Column, c: Column) -> Column:
        digit = c.rlike(which)
        return F.struct(
            F.concat(acc["out"], F.when(digit, signs.substr(acc["i"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (acc["i"] + digit.cast("int")).alias("i"),
        )

    return F.aggregate(F.split(raw, ""), start, step)["out"]


def written_as(raw: Column, kind: Column, found: Column) -> Column:
    """Surrogate parts in the way the entity was written."""
    first = found[0]
    upper = raw == F.upper(raw)
    return (
        F.when(kind == "secret", F.concat(F.regexp_extract(raw, "^" + _SECRET, 0), first))
        .when(kind.isin("phone", "card", "ssn"), _filled(raw, F.regexp_replace(first, "[^0-9]", ""), "^[0-9]$"))
        .when(kind == "iban", _filled(raw, first, "^[A-Z0-9]$"))
        .when(kind.isin("email", "hex_key", "ipv6") & upper, F.upper(first))
        .when(kind == "name", F.concat(F.regexp_extract(raw, f"^[^\\s\\u00A0]+{_GAP}+", 0), _renamed(_untitled(raw), found)))
        .otherwise(first)
    )


def distinct_surrogates(parts: DataFrame, key: str, draw: Callable = surrogate) -> DataFrame:
    """``kind``, ``norm`` and ``sur`` for all parts: no two parts of a kind get the same
    surrogate, and none gets what is itself found in the texts.

    Collisions are looked for over all parts at once; of those that meet, the smallest normal
    form keeps its surrogate and the others draw again, until none is left.
    """
    found = written(parts.select("kind", "norm").distinct().withColumn("attempt", F.lit(0)), "op9-parts")
    state = found
    while True:
        state = written(
            state.withColumn("sur", draw(F.col("kind"), F.col("norm"), F.col("attempt"), key)), "op9-drawn"
        )
        own = state.select("kind", F.lower("sur").alias("taken"), F.col("norm").alias("owner"))
        real = found.select("kind", F.lower("norm").alias("taken"), F.lit(None).cast("string").alias("owner"))
        meets = own.unionByName(real).groupBy("kind", "taken").agg(
            F.min("owner").alias("first"), F.count(F.lit(1)).alias("n"), F.count("owner").alias("owners")
        )
        bad = meets.filter("n > 1 and owners > 0").withColumn("real", F.col("n") > F.col("owners"))
        joined = state.alias("s").join(
            bad.alias("b"), (F.col("s.kind") == F.col("b.kind")) & (F.lower("s.sur") == F.col("b.taken")), "left"
        )
        lost = F.col("b.taken").isNotNull() & (F.col("b.real") | (F.col("s.norm") != F.col("b.first")))
        state = written(
            joined.select("s.kind", "s.norm", (F.col("s.attempt") + lost.cast("int")).alias("attempt"), "s.sur", lost.alias("lost")),
            "op9-checked",
        )
        if state.filter("lost").isEmpty():
            return state.select("kind", "norm", "sur")
        state = state.select("kind", "norm", "attempt")


def replace_entities(documents: DataFrame, text: str, key: str | None = None, counted: str | None = None) -> DataFrame:
    """Documents with all entities in a text column replaced; all other columns stay.

    Equal entities get equal surrogates in all documents, however they are written, and
    different ones different surrogates, except that names written as initials keep one letter
    of theirs only. Texts are searched once, and documents are written with the entities found;
    only those that have some are joined with their replacements, the others pass through.
    Names are found after a title, with all capitalised words that follow on the line, and
    particles between them, which stay; the full names and surnames found so are replaced in the
    same document without a title too, also in capitals. Other names without a title, and digits
    that no mark sets apart as a phone number, stay. Null and empty texts stay.
    ``key`` is that of the session's setting unless given. ``counted`` names a column to add
    with the number of entities replaced.
    """
    names = documents.columns
    key = key or documents.sparkSession.conf.get(KEY_SETTING, KEY)
    row, ents, reps, form = (fresh(names, n) for n in ("_row", "_ents", "_reps", "_form"))
    column = F.col(f"`{text}`")
    searched = written(
        documents.withColumns(
            {
                ents: F.when(may_hold(column), F.regexp_extract_all(column, F.lit(ENTITY), F.lit(0))).otherwise(
                    F.array().cast("array<string>")
                ),
                row: F.monotonically_increasing_id(),
            }
        ),
        "op9-found",
    )
    found = searched.filter(F.size(ents) > 0)
    raws = found.select(F.col(row).alias("row"), F.explode(F.array_distinct(ents)).alias("raw"))
    kind = kind_of(F.col("raw"))
    parts = raws.withColumn("as", kind).select(
        "row", "raw", "as", F.posexplode(parts_of(F.col("raw"), F.col("as"))).alias("pos", "part")
    ).select("row", "raw", "as", "pos", "part.kind", "part.norm")
    known = distinct_surrogates(parts, key)
    # within a document; entities of a busy kind are spread by the join's skew handling
    drawn = parts.join(known, ["kind", "norm"]).groupBy("row", "raw", "as").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "sur"))), lambda x: x["sur"]).alias("surs")
    )
    to_all = drawn.select("row", "raw", written_as(F.col("raw"), F.col("as"), F.col("surs")).alias("to"))
    pairs = [F.struct(n.alias("raw"), _renamed(n, F.when(F.lit(k % 2 == 0), F.col("surs")).otherwise(F.slice("surs", -1, 1))).alias("to"))
             for k, n in enumerate(_bare(F.col("raw")))]
    bare = drawn.filter(F.col("as") == "name").select("row", F.explode(F.array_distinct(F.array(*pairs))).alias("x")).select("row", "x.raw", "x.to")
    to_all = to_all.unionByName(bare).groupBy("row", "raw").agg(F.min("to").alias("to"))
    maps = to_all.groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("raw", "to"))).alias(reps)
    )
    gaps = F.split(column, F.col(form), -1)
    changed = F.transform(F.col(ents), lambda e: F.element_at(F.col(reps), e))
    pieces = F.zip_with(gaps, changed, lambda g, r: F.concat(g, F.coalesce(r, F.lit(""))))
    count = F.size(ents).cast("long")
    to = fresh([*names, row, ents, reps, form], "_to")
    again = found.withColumn(form, with_bare_names(F.col(ents))).withColumn(
        ents, F.when(F.col(form) == ENTITY, F.col(ents)).otherwise(F.regexp_extract_all(column, F.col(form), F.lit(0)))
    )
    done = again.join(maps.withColumnRenamed("row", to), F.col(row) == F.col(to))
    kept = [F.col(f"`{c}`") if c != text else F.array_join(pieces, "").alias(text) for c in names]
    extra = [count.alias(counted)] if counted else []
    none = [F.lit(0).cast("long").alias(counted)] if counted else []
    clean = searched.filter(F.size(ents) == 0).select(*[F.col(f"`{c}`") for c in names], *none)
    return clean.unionByName(done.select(*kept, *extra))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(documents, "text", counted="n_replaced")
