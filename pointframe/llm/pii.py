"""Personal data replaced by keyed surrogates, in DataFrame operations only.

Mentions are found by pattern. A mention's canonical form (digits of a number, lower case of an
address, single names of a person) is the entity that it refers to; every entity of the corpus gets
one surrogate, drawn by a keyed SHA-256 from its kind, canonical form and an attempt number. A
surrogate keeps length and character classes, script and, for first names, gender; IBANs keep their
country, cards their first digit, and both get valid check digits. A mention gets its surrogate in its
own punctuation and case. Surrogates that meet another entity's surrogate, or any entity that occurs in
the corpus, are drawn again until all are distinct, so equal stays equal and different stays different.
That holds for first names too (each has its own within a gender, so persons who share a last name stay
apart): from the second draw on they are composed of several listed names, one more with each draw.
Where a shape is crowded (all two-letter last names occur), draws after the eighth grow longer by one
character each, so the space never runs out. Without the key the replacement can't be repeated.

Texts are scanned twice: once for rows with a mention, which are kept with their pieces, once for the
others. Only rows with a mention are exchanged, by a hash of their text; a text or a mention that is a
third of all rows is resolved once and dealt out over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, salted_join, spread

# kind and pattern, in order of precedence: fixed values
PATTERNS = [
    ("email", r"(?<![\p{L}\p{N}_%+-])(?<![\p{L}\p{N}_%+-]\.)[\p{L}\p{N}_%+-]++(?:\.[\p{L}\p{N}_%+-]++)*+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("card", r"(?<!\d)(?:\d{4}[ -]){3}\d{4}(?!\d)|(?<!\d)\d{15,16}(?!\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?|\d{2,4}[ .-])\d{2,4}(?:[ .-]\d{2,4}){1,3}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<!\d)\d{3}-\d{3}-\d{4}(?!\d)"),
    ("man", r"\b(?:Mr|Herr|Monsieur|Señor|Господин)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"),
    ("woman", r"\b(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Señorita|Госпожа)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"),
]

# first names by script and gender: fixed values
FIRST_NAMES = {
    ("latin", "man"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Marco Nils Oscar Pablo Robin Simon Tomas Victor".split(),
    ("latin", "woman"): "Ada Bella Clara Diana Elena Flora Greta Hanna Irene Julia Klara Laura Maria Nora Olivia Paula Rosa Sofia Teresa Vera".split(),
    ("cyrillic", "man"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Никита Олег Павел Роман Сергей".split(),
    ("cyrillic", "woman"): "Анна Вера Галина Дарья Елена Жанна Ирина Лариса Мария Нина Ольга Полина София Татьяна".split(),
}

_UNION = "|".join(f"(?:{p})" for _, p in PATTERNS)
# what every mention holds one of: cheap to look for, and most texts hold none
_HINT = r"[@0-9]|\b(?:Mr|Herr|Monsieur|Señor|Господин|Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Señorita|Госпожа)\.? \p{Lu}"
_NAMES = ("man", "woman")
_GROW = 8  # draws before surrogates grow longer
_CYRILLIC, _GREEK = "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"


def mentions(text: Column) -> Column:
    """All mentions of a text, in order."""
    return F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(_UNION), F.lit(0)))


def kind_of(mention: Column) -> Column:
    """The first kind whose pattern is the whole mention."""
    out = F.lit(PATTERNS[-1][0])
    for kind, pattern in reversed(PATTERNS[:-1]):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _stream(key: Column, chars: Column) -> Column:
    """Hex digits of a keyed hash, two for each character."""
    blocks = F.transform(F.sequence(F.lit(0), (F.length(chars) / 32).cast("int")), lambda b: F.sha2(F.concat_ws("|", key, b.cast("string")), 256))
    return F.array_join(blocks, "")


def _redrawn(chars: Column, stream: Column) -> Column:
    """Every digit and letter replaced by one of its class that the stream picks; the rest kept."""

    def one(c: Column, i: Column) -> Column:
        n = F.conv(F.substring(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        pick = lambda letters: F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))
        low = F.when(c.rlike(r"\p{IsCyrillic}"), pick(_CYRILLIC)).when(c.rlike(r"\p{IsGreek}"), pick(_GREEK)).otherwise(pick("abcdefghijklmnopqrstuvwxyz"))
        return F.when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike(r"\p{Lu}"), F.upper(low)).when(c.rlike(r"\p{L}"), low).otherwise(c)

    return F.array_join(F.transform(F.split(chars, ""), one), "")


def _listed(names: list[str], stream: Column):
    return lambda i: F.element_at(F.array(*map(F.lit, names)), F.conv(F.substring(stream, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % len(names) + 1)


def _mod97(chars: Column) -> Column:
    """Remainder of a number written in digits and capitals (10 to 35) by 97."""
    value = lambda c: F.conv(c, 36, 10).cast("int")
    return F.aggregate(F.split(chars, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise((r * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97))


def _iban(entity: Column, grown: Column, stream: Column) -> Column:
    """Country kept, account redrawn, check digits computed."""
    country, account = F.substring(entity, 1, 2), _redrawn(F.concat(F.expr("substring(entity, 5)"), grown), stream)
    return F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)


def _card(entity: Column, grown: Column, stream: Column) -> Column:
    """First digit kept, the last one computed by the Luhn rule, the others redrawn."""
    body = F.concat(F.substring(entity, 1, 1), _redrawn(F.concat(F.expr("substring(entity, 2, length(entity) - 2)"), grown), stream))
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    digits = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(i % 2 == 0, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.concat(body, ((10 - F.aggregate(digits, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10) % 10).cast("string"))


def _surrogate(kind: Column, entity: Column, key: Column, attempt: Column) -> Column:
    """Surrogate of a canonical entity (column ``entity``) under ``key``, which holds the attempt.

    First names: 1 + ``attempt`` listed names in one. From attempt ``_GROW`` on all others are longer than the
    entity: names, numbers and IBANs at their end, addresses at their start, and IPs are of version 6.
    """
    more = F.greatest(F.lit(0), attempt - _GROW + 1)
    grown = lambda c: F.repeat(F.lit(c), more)
    stream = _stream(key, F.concat(entity, grown("x")))
    pick = lambda at, n: F.conv(F.substring(stream, at, 4), 16, 10).cast("int") % n
    octets = F.concat_ws(".", *[(pick(1 + 4 * i, 254) + 1).cast("string") for i in range(4)])
    octets = F.when(more == 0, octets).otherwise(F.concat(F.lit("2001:db8"), *[x for i in range(6) for x in (F.lit(":"), F.substring(stream, 1 + 4 * i, 4))]))
    tld = F.regexp_extract(entity, r"(\.\p{L}+)$", 1)
    body = F.expr("left(entity, length(entity) - length(regexp_extract(entity, '([.]\\\\p{L}+)$', 1)))")
    address = F.concat(_redrawn(F.concat(grown("x"), body), stream), tld)
    country = F.regexp_extract(entity, r"^(\+\d+ )", 1)
    abroad = F.concat(country, _redrawn(F.concat(F.regexp_replace(entity, r"^\+\d+ ", ""), grown("0")), stream))
    out = F.when(kind == "ip", octets).when((kind == "email") & (F.instr(entity, "@") > 0), address).when(country != "", abroad)
    out = out.when((kind == "iban") & entity.rlike("^[A-Z]{2}"), _iban(entity, grown("0"), stream)).when((kind == "card") & entity.rlike("^[0-9]+$"), _card(entity, grown("0"), stream))
    for (script, gender), names in FIRST_NAMES.items():
        of_script = entity.rlike(r"\p{IsCyrillic}") if script == "cyrillic" else ~entity.rlike(r"\p{IsCyrillic}")
        out = out.when((kind == gender) & of_script, F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), F.least(attempt, F.lit(15))), _listed(names, stream)), "")))
    last = F.when(entity.rlike(r"\p{IsCyrillic}"), grown("я")).when(entity.rlike(r"\p{IsGreek}"), grown("ω")).otherwise(grown("x"))
    return out.otherwise(_redrawn(F.concat(entity, F.when(entity.rlike("[0-9]$"), grown("0")).otherwise(last)), stream))


def _parts(kind: str = "kind", mention: str = "mention") -> Column:
    """Entities of a mention: (kind, canonical form). Persons: first names by gender, last names as 'name'."""
    m, k = F.col(mention), F.col(kind)
    words = F.slice(F.split(m, " "), F.lit(2), F.size(F.split(m, " ")))
    person = F.when(
        F.size(words) == 2, F.array(F.struct(k.alias("kind"), words[0].alias("entity")), F.struct(F.lit("name").alias("kind"), words[1].alias("entity")))
    ).otherwise(F.array(F.struct(F.lit("name").alias("kind"), words[0].alias("entity"))))
    numbers = F.regexp_replace(m, "[^0-9]", "")
    country = F.regexp_extract(m, r"^\+(\d{1,3})[ .(-]", 1)
    digits = F.struct(k.alias("kind"), F.when(country != "", F.concat(F.lit("+"), country, F.lit(" "), F.expr("substring(regexp_replace(mention, '[^0-9]', ''), length(regexp_extract(mention, '^[+]([0-9]{1,3})[ .(-]', 1)) + 1)"))).otherwise(numbers).alias("entity"))
    iban = F.struct(k.alias("kind"), F.replace(m, F.lit(" "), F.lit("")).alias("entity"))
    plain = F.struct(k.alias("kind"), F.lower(m).alias("entity"))
    return F.when(k.isin(*_NAMES), person).when(k.isin("phone", "card", "ssn"), F.array(digits)).when(k == "iban", F.array(iban)).otherwise(F.array(plain))


def entity_surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """One distinct ``surrogate`` for each distinct ``(kind, entity)``, never an entity that occurs itself.

    Each draw asks only those that clashed in the last one; longer draws make the space larger than any corpus.
    """
    known = cut(entities.select("kind", "entity").distinct())
    draw = lambda df: df.withColumn("surrogate", _surrogate(F.col("kind"), F.col("entity"), F.concat_ws("|", F.lit(secret), "kind", "entity", F.col("attempt").cast("string")), F.col("attempt")))
    table = cut(draw(known.withColumn("attempt", F.lit(0))))
    while True:
        keepers = table.groupBy("kind", "surrogate").agg(F.min("entity").alias("keeper"), F.count("*").alias("n"))
        crowded = table.join(keepers.where("n > 1"), ["kind", "surrogate"]).where("entity <> keeper").select("kind", "entity")
        real = table.join(known.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_semi").select("kind", "entity")
        again = cut(crowded.unionByName(real).distinct())
        if again.isEmpty():
            return table.select("kind", "entity", "surrogate")
        redrawn = draw(table.join(again, ["kind", "entity"], "left_semi").withColumn("attempt", F.col("attempt") + 1).drop("surrogate"))
        table = cut(table.join(again, ["kind", "entity"], "left_anti").unionByName(redrawn))


def _in_the_form_of(mention: Column, kind: Column, found: Column) -> Column:
    """Write surrogates in a mention's own punctuation, case and spacing; what a longer one has more stands at its end
    (addresses: at its start)."""
    number = kind.isin("phone", "card", "ssn")
    s = F.when(number, F.regexp_replace(found[0], "[^0-9]", "")).otherwise(found[0])
    title = F.substring_index(mention, " ", 1)
    chars = F.split(mention, "")
    placed = lambda own: F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(own), F.substring(s, F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), f"[^{own[1:-1]}]", "")), F.lit(1))).otherwise(c)), "")
    rest = lambda own: F.substring(s, F.length(F.regexp_replace(mention, f"[^{own[1:-1]}]", "")) + 1, F.length(s))
    more = F.length(s) - F.length(mention)
    cased = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(r"\p{Lu}"), F.upper(F.substring(s, more + i + 1, F.lit(1)))).otherwise(F.substring(s, more + i + 1, F.lit(1)))), "")
    return (
        F.when(kind.isin(*_NAMES), F.concat_ws(" ", title, F.array_join(found, " "))).when(number, F.concat(placed("[0-9]"), rest("[0-9]")))
        .when(kind == "iban", F.concat(placed("[A-Z0-9]"), rest("[A-Z0-9]"))).when(kind == "email", F.concat(F.substring(s, F.lit(1), more), cased)).otherwise(s)
    )


def replace_private(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``text`` with every mention replaced, ``n_entities`` (mentions
    replaced) and ``kinds`` (their kinds in order). ``secret`` is the key; an empty one raises ``ValueError``.

    Null texts stay null with no mentions; texts without mentions are returned as they are; very long texts
    are scanned whole, in linear time. Repeated rows give repeated rows. An empty table gives an empty table;
    other columns are not read.
    """
    if not secret:
        raise ValueError("surrogates need a key that is kept secret")
    base = spread(docs.select(F.col(id_col), F.col(text_col).alias("text")))
    holds = F.coalesce(F.col("text").rlike(_HINT) & F.col("text").rlike(_UNION), F.lit(False))
    clean = base.where(~holds).select(id_col, "text", F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    # a text is kept as the pieces between its mentions and the mentions themselves
    dirty = base.withColumn("found", F.coalesce(mentions(F.col("text")), F.array().cast("array<string>"))).where(F.size("found") > 0)
    dirty = cut(dirty.select(id_col, "found", F.split("text", _UNION, -1).alias("rest"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("2"), "text").alias("h2")))
    texts = cut(dirty.select("h1", "h2", F.array_distinct("found").alias("said")).dropDuplicates(["h1", "h2"]))
    said = texts.select("h1", "h2", F.explode("said").alias("mention"))
    distinct = cut(said.select("mention").distinct().withColumn("kind", kind_of(F.col("mention"))))
    parts = distinct.select("mention", "kind", F.posexplode(_parts()).alias("at", "part")).select("mention", F.col("kind").alias("of"), "at", "part.kind", "part.entity")
    table = entity_surrogates(parts, secret)
    resolved = parts.join(table, ["kind", "entity"]).groupBy("mention", "of").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "surrogate"))), lambda x: x.surrogate).alias("names"))
    written = cut(resolved.select("mention", F.struct(F.col("of").alias("kind"), _in_the_form_of(F.col("mention"), F.col("of"), F.col("names")).alias("surrogate")).alias("new")))
    maps = salted_join(said, written, ["mention"]).groupBy("h1", "h2").agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias("new"))
    joined = salted_join(dirty, maps, ["h1", "h2"])
    rewritten = F.array_join(F.zip_with("rest", F.transform("found", lambda m: F.col("new")[m].surrogate), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = joined.select(id_col, rewritten.alias("text"), F.size("found").alias("n_entities"), F.transform("found", lambda m: F.col("new")[m].kind).alias("kinds"))
    return clean.unionByName(changed)
