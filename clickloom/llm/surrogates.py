"""Surrogates for personal data, with Spark functions only.

Entities are found by patterns. Each distinct one, in a canonical form so that other spellings of it agree, gets a keyed
surrogate of its type: digits for digits in the same format, names by title, gender and script, addresses in reserved
ranges. Surrogates are checked against each other and against all real entities; whoever collides, but the first, is
drawn again. One entity has one surrogate everywhere, two entities have two.

Defined cases: a null text stays null and has no entity; other columns stay as they are, those named like an
output column (the text, ``n_entities``) are replaced; repeated rows are replaced alike; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.columns import let, packed, unpacked
from clickloom.llm.tables import stored

# Titles before a name, by gender.
MALE_TITLES = "Mr|Herr|Monsieur|Señor|Sr|Don|Господин|Κύριος"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Doña|Госпожа|Κυρία"
NEUTRAL_TITLES = "Dr|Prof"
TITLES = f"{MALE_TITLES}|{FEMALE_TITLES}|{NEUTRAL_TITLES}"
# Given names by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Noah Oscar Paul",
    ("latin", "f"): "Anna Berta Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula",
    ("latin", "n"): "Alex Charlie Dana Eden Frankie Jamie Jordan Kim Lee Morgan Noel Quinn Robin Sam Taylor Toni",
    ("cyrillic", "m"): "Алексей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей Тимур",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Нина Ольга Полина Раиса Софья",
    ("greek", "m"): "Άγγελος Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Ιάσων Κώστας",
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ηλέκτρα Θάλεια",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke la le lo ma me mo na ne no pa ra re ro sa so ta te to va vo",
    "cyrillic": "ба бе бо да де до ка ко ла ле ло ма мо на не но ра ро са со та то ва во",
    "greek": "βα γα δα ζα κα λα μα να πα ρα σα τα βο γο δο κο λο μο νο πο ρο σο το φο",
}

_FREE, _END = r"(?<![\p{L}\p{N}._%+-])", r"(?![\p{L}\p{N}])"
PATTERNS = {
    "email": _FREE + r"[\p{L}\p{N}._%+-]++@[\p{L}\p{N}](?:[\p{L}\p{N}-]*\.)+\p{L}{2,}",
    "name": r"(?<![\p{L}\p{N}])(?:" + TITLES + r")\.? \p{Lu}[\p{Ll}'’-]+(?: \p{Lu}[\p{Ll}'’-]+)?" + _END,
    "key": r"(?<![\p{L}\p{N}])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _END,
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "ip": r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?![\p{L}\p{N}]|\.\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})" + _END,
    "card": r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})" + _END,
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
QUICK = r"@|\d[^\p{L}]*\d|[0-9a-fA-F]{32}|\b(?:" + TITLES + r")\.? \p{Lu}"


def entities(text: Column) -> Column:
    """All entities of ``text`` in order."""
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    return F.when(text.rlike(QUICK), found).otherwise(F.array().cast("array<string>"))


def kind_of(value: Column) -> Column:
    """The type of an entity: the first pattern that it matches as a whole."""
    kind = F.lit("card")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def canonical(kind: Column, value: Column) -> Column:
    """What spellings of one entity have in common."""
    bare = F.regexp_replace(value, rf"^(?:{TITLES})\.? ", "")
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind == "name", F.concat(_gender(value), F.lit(":"), bare))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(value, r"\D", ""))
        .otherwise(value)
    )


def _gender(value: Column) -> Column:
    return F.when(value.rlike(rf"^(?:{MALE_TITLES})\b"), "m").when(value.rlike(rf"^(?:{FEMALE_TITLES})\b"), "f").otherwise("n")


def _script(value: Column) -> Column:
    bare = F.regexp_replace(value, rf"^(?:[mfn]:|(?:{TITLES})\.? )", "")
    return F.when(bare.rlike(r"\p{IsCyrillic}"), "cyrillic").when(bare.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _number(stream: Column, at: int, count: int) -> Column:
    """A number below ``count`` from five hexadecimal digits of ``stream``."""
    return F.conv(F.substring(stream, at, 5), 16, 10).cast("long") % count


def _pick(words: str, stream: Column, at: int) -> Column:
    listed = words.split()
    return F.element_at(F.array(*map(F.lit, listed)), (_number(stream, at, len(listed)) + 1).cast("int"))


def _name(canon: Column, stream: Column) -> Column:
    out = F.lit(None).cast("string")
    for script in SYLLABLES:
        surname = F.initcap(F.concat(*(_pick(SYLLABLES[script], stream, 6 + 5 * i) for i in range(4))))
        for gender in "mfn":
            given = GIVEN.get((script, gender)) or GIVEN[script, "m"] + " " + GIVEN[script, "f"]
            full = F.concat(_pick(given, stream, 1), F.lit(" "), surname)
            # One word stays one word.
            made = F.when(F.instr(canon, " ") > 0, full).otherwise(surname)
            fits = (_script(canon) == script) & (F.substring(canon, 1, 1) == gender)
            out = F.when(fits, F.concat(F.lit(f"{gender}:"), made)).otherwise(out)
    return out


def _shaped(value: Column, stream: Column) -> Column:
    """``value`` with other digits for digits and other letters for letters; everything else stays."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def place(c: Column, i: Column) -> Column:
        n = F.conv(F.substring(stream, (i % 60) + 1, 3), 16, 10).cast("long")
        return (
            F.when(c.rlike(r"\d"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.substring(F.lit(upper), (n % 26).cast("int") + 1, 1))
            .when(c.rlike(r"\p{L}"), F.substring(F.lit(lower), (n % 26).cast("int") + 1, 1))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), place), "")


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of an entity at an attempt; a function of the key."""

    def made(stream: Column) -> Column:
        digits = F.translate(stream, "abcdef", "024681")
        size = F.length(canon)
        domain = F.concat(F.translate(F.substring(stream, 1, 8), "0123456789", "ghijklmnop"), F.lit(".example"))
        octets = F.concat_ws(".", F.lit("10"), *(_number(stream, at, 256).cast("string") for at in (1, 6, 11)))
        hexes = F.substring(F.concat(stream, F.reverse(stream)), 1, size)
        keyed = F.when(canon.rlike("^[0-9a-f]+$"), hexes).when(canon.rlike("^[0-9A-F]+$"), F.upper(hexes))
        local = F.substring_index(canon, "@", 1)
        return (
            F.when(kind == "email", F.concat(_shaped(local, stream), F.lit("@"), domain))
            .when(kind == "name", _name(canon, stream))
            .when(kind == "key", keyed.otherwise(_shaped(canon, stream)))
            .when(kind == "ip", octets)
            .when(kind == "iban", F.concat(F.substring(canon, 1, 2), _shaped(F.substring(canon, 3, 99), stream)))
            .when(kind == "phone", F.concat(F.substring(canon, 1, 1), F.substring(digits, 1, size - 1)))
            .otherwise(F.concat(F.lit("9"), F.substring(digits, 1, size - 1)))
        )

    mixed = F.sha2(F.concat_ws("\n", F.lit(key), kind, canon, attempt.cast("string")), 256)
    return let(mixed, made)


def _respelled(kind: Column, value: Column, new: Column) -> Column:
    """The surrogate in the spelling of ``value``: its title, separators and spaces."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        filled = F.struct(F.concat(acc["out"], F.substring(new, acc["k"] + 1, 1)).alias("out"), (acc["k"] + 1).alias("k"))
        kept = F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k"))
        return F.when(c.rlike(r"[\p{L}\p{N}]"), filled).otherwise(kept)

    filled = F.aggregate(F.split(value, ""), start, step)["out"]
    title = F.regexp_extract(value, rf"^(?:{TITLES})\.? ", 0)
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), filled)
        .when(kind == "name", F.concat(title, F.substring(new, 3, 200)))
        .otherwise(new)
    )


def surrogate_table(values: DataFrame, key: str) -> DataFrame:
    """(value, surrogate) for a table of distinct entities (value)."""
    kinds = values.withColumn("kind", kind_of(F.col("value")))
    kinds = stored(kinds.withColumn("canon", canonical(F.col("kind"), F.col("value"))), "entities")
    known = kinds.select("kind", "canon").distinct().withColumn("attempt", F.lit(0))
    while True:
        known = known.withColumn("new", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
        real = kinds.select(F.col("kind").alias("k"), F.col("canon").alias("new_is")).distinct()
        first = F.row_number().over(Window.partitionBy("kind", "new").orderBy("attempt", "canon")) == 1
        judged = known.withColumn("first", first).join(
            real, (F.col("kind") == F.col("k")) & (F.col("new") == F.col("new_is")), "left"
        )
        known = stored(
            judged.select("kind", "canon", "attempt", "new", (~F.col("first") | F.col("new_is").isNotNull()).alias("again")),
            "surrogates",
        )
        if not known.where("again").limit(1).count():
            break
        known = known.select("kind", "canon", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
    new = _respelled(F.col("kind"), F.col("value"), F.col("new"))
    return kinds.join(known.select("kind", "canon", "new"), ["kind", "canon"]).select("value", new.alias("surrogate"))


def replace_entities(docs: DataFrame, text: str = "text", key: str = "surrogate key") -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``, the number of places replaced."""
    rows = packed(docs, t=F.col(text)).withColumn("found", entities(F.coalesce("t", F.lit(""))))
    plain, marked = rows.where(F.size("found") == 0), rows.where(F.size("found") > 0)
    # Texts are told apart by their digest: equal texts have equal replacements.
    met = marked.select(F.sha2("t", 256).alias("digest"), F.explode(F.array_distinct("found")).alias("value"))
    met = stored(met.distinct(), "met")
    table = surrogate_table(met.select("value").distinct(), key)
    lists = met.join(table, "value").groupBy("digest").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("new")
    )
    joined = marked.withColumn("d", F.sha2("t", 256)).join(lists, F.col("d") == F.col("digest"))
    parts = F.split("t", ENTITY)
    put = F.transform("found", lambda v: F.element_at("new", v))
    whole = F.array_join(
        F.zip_with(parts, put, lambda gap, v: F.concat(gap, F.coalesce(v, F.lit("")))), ""
    )
    done = joined.select("row", whole.alias("t"), "found").unionByName(plain.select("row", "t", "found"))
    return unpacked(done, docs.columns, **{text: F.col("t"), "n_entities": F.size("found").cast("long")})
