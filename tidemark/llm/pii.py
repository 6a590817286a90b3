"""Personal data: detection and consistent surrogates, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
#: Also next to other letters, such as the x of 0x.
SECRET = r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}+"
PHONE = r"\+\d{1,3} ?\(?\d{2,4}\)?[ -]?\d{3,4}[ -]?\d{3,4}(?!\d)"
CARD = r"(?<![0-9A-Za-z])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![0-9A-Za-z])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IP = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?![\d]|\.\d)"
SSN = r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"
#: Titles that go before a name, by gender.
FEMALE, MALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Г-жа", "Mr|Herr|Monsieur|Señor|Sr|Г-н"
NAME = rf"(?:(?<![\p{{L}}\p{{N}}_])(?:{FEMALE}|{MALE})\.?) \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
#: An address starts where its run of characters does, or after the entity before: no start within a run is tried.
_EMAIL_START = r"(?:(?<![A-Za-z0-9._%+-])|\G)"
_PATTERNS = (_EMAIL_START + EMAIL.replace("+@", "++@"), SECRET, PHONE, CARD, IP, SSN, NAME)
ALL = "|".join(["(?:" + p.replace(r"([ -]?)", r"(?:[ -]?)").replace(r"\1", "[ -]?") + ")" for p in _PATTERNS])
#: Nothing starts after a letter of A to Z but numbers, secrets, and what stands next to the entity before; tried first, as it fails fast.
_START = r"(?:(?<![A-Za-z])|(?=[+0-9])|(?<=[G-Zg-z])(?=[A-Fa-f][0-9A-Fa-f]{31})|\G)"
#: Mark around entities, and what stands for its first character in a text.
_MARK, _HEAD, _ESCAPED = "\u0001\u0003", "\u0001", "\u0001\u0002"
#: Syllables of surrogate names, by script.
LATIN = ("ba", "de", "fi", "go", "ku", "la", "me", "ni", "po", "ra", "se", "ti", "vo", "ya", "ze", "lu")
CYRILLIC = ("ба", "де", "фи", "го", "ку", "ла", "ме", "ни", "по", "ра", "се", "ти", "во", "ря", "зе", "лу")
#: Attempts in which numbers keep their first digit, and rounds without a single new surrogate after which all forms are used up.
FIRST, IDLE = 8, 64
#: Endings of surrogate first names, by gender.
ENDINGS = {"f": ("na", "на"), "m": ("n", "н")}


def _kind(v):
    whole = lambda p: v.rlike(f"^(?:{p})$")
    return (
        F.when(v.contains("@"), "email").when(whole("[0-9A-Fa-f]{32,}"), "secret").when(v.startswith("+"), "phone")
        .when(whole(r"\d{3}-\d{2}-\d{4}"), "ssn").when(whole(r"[\d -]+"), "card").when(whole(r"[\d.]+"), "ip").otherwise("name")
    )


def _canon(kind, v):
    """What the spellings of one entity have in common."""
    name = F.lower(F.regexp_replace(v, r"^\S+ ", ""))
    gender = F.when(v.rlike(rf"^(?:{FEMALE})(?!\p{{L}})"), "f ").otherwise("m ")
    return F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(v, r"\D", "")).when(kind == "name", F.concat(gender, name)).otherwise(F.lower(v))


def _stream(kind, canon, key: str, attempt: int):
    """128 bytes of a keyed hash, as hex."""
    return F.concat(*[F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit(f"{attempt}-{part}"), kind, canon), 512) for part in range(2)])


def _surrogate(kind, canon, stream, attempt: int = 0):
    """A replacement of the canonical form, of the same type, from the bytes of `stream`.

    Names get a syllable and addresses a digit more with each attempt. Numbers and secrets keep
    their length; phone, card and SSN numbers keep their first digit for FIRST attempts.
    """
    byte = lambda i: F.conv(F.substring(stream, (i % 128) * 2 + 1, 2), 16, 10).cast("int")
    pick = lambda alphabet, i: F.substring(F.lit(alphabet), byte(i) % len(alphabet) + 1, 1)

    def shape(text, letters):
        def one(c, i):
            return F.when(c.rlike("[0-9]"), pick("0123456789", i)).when(c.rlike("[a-z]"), pick(letters, i)).otherwise(c)

        return F.array_join(F.transform(F.split(text, ""), one), "")

    def double(d, i):
        twice = d * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    def luhn(digits):
        numbers = F.transform(F.split(F.reverse(digits), ""), lambda c, i: double(c.cast("int"), i))
        return F.aggregate(numbers, F.lit(0), lambda t, x: t + x) % 10

    email = F.concat(shape(F.substring_index(canon, "@", 1), "abcdefghijklmnopqrstuvwxyz"), F.lit("@mail"), *[pick("0123456789", F.lit(200 - i)) for i in range(4 + attempt)], F.lit(".example.org"))
    number = F.concat(F.substring(canon, 1, 1), shape(F.substring(canon, 2, 100), "a")) if attempt < FIRST else shape(canon, "a")
    body = F.concat(F.substring(number, 1, 15), F.lit("0"))
    # the check digit is right where the original's is
    last = ((luhn(canon) - luhn(body) + 10) % 10).cast("string")
    card = F.concat(F.substring(number, 1, 15), last)
    ip = F.concat_ws(".", *[(byte(F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    def named(syllables, ending):
        made = lambda start, more=0: F.concat(*[F.element_at(F.array(*map(F.lit, syllables)), byte(F.lit(start + i)) % 16 + 1) for i in range(4 + more)])
        both = F.concat(F.initcap(F.concat(made(0), F.when(canon.startswith("f "), ending["f"]).otherwise(ending["m"]))), F.lit(" "), F.initcap(made(8, attempt)))
        return F.when(F.size(F.split(canon, " ")) > 2, both).otherwise(F.initcap(made(8, attempt)))

    cyrillic = canon.rlike(r"\p{IsCyrillic}")
    name = F.when(cyrillic, named(CYRILLIC, {g: e[1] for g, e in ENDINGS.items()})).otherwise(named(LATIN, {g: e[0] for g, e in ENDINGS.items()}))
    return F.when(kind == "email", email).when(kind == "secret", shape(canon, "abcdef")).when(kind == "card", card).when(kind == "ip", ip).when(kind == "name", name).otherwise(number)


def _rendered(kind, v, made):
    """The surrogate in the spelling of one value: its separators, its title, its capitals."""
    nth = lambda i: F.length(F.regexp_replace(F.substring(v, F.lit(1), i + 1), r"\D", ""))
    digits = F.array_join(F.transform(F.split(v, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(made, nth(i), F.lit(1))).otherwise(c)), "")
    capitals = F.array_join(F.zip_with(F.split(v, ""), F.split(made, ""), lambda c, m: F.when(c.rlike("[A-F]"), F.upper(m)).otherwise(m)), "")
    return F.when(kind.isin("phone", "card", "ssn"), digits).when(kind == "secret", capitals).when(kind == "name", F.concat(F.regexp_extract(v, r"^(\S+ )", 1), made)).otherwise(made)


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(value, kind, surrogate) for distinct values of `found` (column value).

    Spellings of one entity share a surrogate; two entities never do, and none is an entity of the
    corpus itself. Rounds: entities whose surrogate clashes draw again with the next attempt, names
    and addresses from a larger space, so that any number of them ends. The last place goes to the
    smallest entity, so the result does not depend on the order of rows. Only numbers of one form
    can run out, when entities and surrogates fill it; the job fails then.
    """
    values = stage(found.select("value").distinct().withColumn("kind", _kind(F.col("value"))).withColumn("canon", _canon(F.col("kind"), F.col("value"))), "pii-values")
    real = stage(values.select("kind", "canon").distinct(), "pii-entities")
    fixed, todo, attempt, left, idle = None, real, 0, real.count(), 0
    while True:
        drawn = todo.withColumn("stream", _stream(F.col("kind"), F.col("canon"), key, attempt))
        drawn = drawn.withColumn("made", _surrogate(F.col("kind"), F.col("canon"), F.col("stream"), attempt)).drop("stream").withColumn("made_canon", F.when(F.col("kind") == "name", F.concat(F.substring("canon", 1, 2), F.lower("made"))).otherwise(F.col("made")))
        drawn = stage(drawn, "pii-drawn")
        first = drawn.groupBy("kind", "made").agg(F.min("canon").alias("canon"))
        good = drawn.join(first, ["kind", "made", "canon"], "left_semi").join(real.select("kind", F.col("canon").alias("made_canon")), ["kind", "made_canon"], "left_anti")
        if fixed is not None:
            good = good.join(fixed.select("kind", "made"), ["kind", "made"], "left_anti")
        good = stage(good.select("kind", "canon", "made"), "pii-surrogates")
        fixed = good if fixed is None else fixed.union(good)
        todo = stage(todo.join(good, ["kind", "canon"], "left_anti"), "pii-todo")
        attempt += 1
        before, left = left, todo.count()
        if not left:
            break
        idle = idle + 1 if left == before else 0
        if idle == IDLE:
            raise RuntimeError("the numbers of one form are used up by the entities found")
    out = values.join(fixed, ["kind", "canon"])
    return out.select("value", "kind", _rendered(F.col("kind"), F.col("value"), F.col("made")).alias("surrogate"))


def _parts(text):
    """A text split at its entities in one pass: entities have the odd places."""
    marked = F.regexp_replace(F.replace(text, F.lit(_HEAD), F.lit(_ESCAPED)), f"{_START}({ALL})", f"{_MARK}$1{_MARK}")
    return F.split(marked, _MARK, -1)


def replace(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """`docs` with entities of the text column replaced, and n_pii, how many were.

    Texts are split at their entities once and written with a number for each row; only places and
    values are shuffled, and of the texts only those with entities. Null texts stay null, texts
    without entities stay as they are; repeated ids and rows are all kept. Other columns pass through.
    """
    columns = docs.columns
    others = [c for c in columns if c != text_col]
    carried = F.struct(*others) if others else F.lit(None).cast("string")
    split = stage(docs.select(F.monotonically_increasing_id().alias("row"), carried.alias("carried"), _parts(F.col(text_col)).alias("parts")), "pii-split")
    plain = split.where(F.coalesce(F.size("parts"), F.lit(0)) <= 1)
    with_ents = split.where(F.size("parts") > 1)
    places = with_ents.select("row", F.posexplode("parts").alias("at", "value")).where("at % 2 = 1")
    made = places.join(surrogates(places, key), "value").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("made"))
    made = made.select("row", F.col("made.surrogate").alias("made"))
    whole = F.transform("parts", lambda part, i: F.when(i % 2 == 1, F.get("made", F.shiftright(i, 1))).otherwise(part))
    changed = with_ents.join(made, "row")

    def rows(part, texts):
        text = F.replace(F.array_join(texts, ""), F.lit(_ESCAPED), F.lit(_HEAD))
        n = F.greatest(F.lit(0), F.floor((F.size("parts") - 1) / 2)).cast("long")
        return part.select(*[text.alias(c) if c == text_col else F.col("carried").getField(c).alias(c) for c in columns], F.coalesce(n, F.lit(0).cast("long")).alias("n_pii"))

    return rows(plain, F.col("parts")).unionByName(rows(changed, whole))
