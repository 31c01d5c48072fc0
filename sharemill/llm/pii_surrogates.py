"""Surrogates for personal data, in DataFrame operations alone.

Entities are found by patterns; equal entities, also when written differently, get the same surrogate everywhere, and
different ones different surrogates. A surrogate is drawn by a keyed hash in the entity's own format: digits for
digits, letters for letters, names by gender and script. Draws that meet another one, or anything found in the
texts, are repeated. Texts are then put together again from what lies between the entities and the surrogates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharemill.llm.tables import fresh, quoted, staged

# Titles that tell a name, by the bearer's gender.
MALE = ("Mr", "Mister", "Herr", "Señor", "Monsieur", "Sr", "г-н", "господин", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "Sra", "г-жа", "госпожа", "κυρία")
_TITLES = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
#: Titles in any case, except "miss" and "ms" in lower case: a verb and a unit. The name after one starts with a capital.
_TITLE = rf"(?!(?:miss|ms)\b)(?iu:{_TITLES})"
_NAME = r"\p{Lu}[\p{L}'’-]+"

#: Kind and pattern, the first that matches at a place counts. Leading runs are possessive and start where a word
#: starts, so that the search stays linear in long words.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "access_key": r"(?<![A-Z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    # the first test looks back three signs only: it spares most places the second
    "secret": r"(?<=[=:] ?[\"']?)(?<=(?i:password|passwd|secret|token|api_key)(?: ?[=:] ?[\"']?))(?=[/+_-]{0,199}[A-Za-z0-9])[A-Za-z0-9/+_-]{8,200}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "person": rf"(?<!\p{{L}}){_TITLE}\.? {_NAME}(?: {_NAME})?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What no entity is without, in lower case: a digit or at-sign, the name of a secret or key, or a title (here by stems of
#: them all, with a blank or period after those that are short).
HINTS = (
    "password", "passwd", "secret", "token", "api_key", "akia", *(f"{t}{end}" for t in ("mr", "mrs", "ms", "sr", "sra", "mme") for end in " ."),
    "miss ", "mister", "miss.", "madame", "monsieur", "herr", "frau", "señor", "г-", "госпо", "κύρι", "κυρί",
)

# Syllables and endings of drawn names, by script.
SYLLABLES = {
    "Latin": ("ba", "be", "da", "do", "fe", "ga", "ha", "jo", "ka", "la", "le", "ma", "mi", "na", "ne", "pa", "ra", "ro", "sa", "to", "ve", "wi"),
    "Cyrillic": ("ба", "ва", "га", "да", "же", "за", "ка", "ли", "ма", "ми", "на", "ни", "по", "ра", "ро", "са", "та", "фе"),
    "Greek": ("βα", "γα", "δη", "ζα", "θε", "κα", "λε", "μα", "νι", "πα", "ρο", "σα", "τι", "φι"),
}
ENDINGS = {
    "Latin": {"given_m": ("n", "r", "l", "s", "rd"), "given_f": ("na", "la", "ra", "lia", "sa"), "family": ("ner", "ler", "ros", "man", "ton")},
    "Cyrillic": {"given_m": ("н", "р", "л", "м"), "given_f": ("на", "ра", "ля", "ня"), "family": ("нов", "рин", "лев", "ский")},
    "Greek": {"given_m": ("ος", "ης", "ας"), "given_f": ("α", "η", "ια"), "family": ("ίδης", "άκης", "όπουλος")},
}
MAX_DRAWS = 64
#: Draws in a unit's own format; each further one is longer by one more character, so that there is always room.
IN_FORMAT = 8


def _stream(key: str, attempt: Column, *parts: Column, length: Column) -> Column:
    """Pseudorandom numbers 0..255 (an array of ``length``) from the key, the parts and the number of the draw."""
    text = F.concat_ws("\u0001", F.lit(key), *parts, attempt.cast("string"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(length / 32).cast("int")), lambda b: F.sha2(F.concat_ws("\u0001", text, b.cast("string")), 256))
    hexes = F.array_join(blocks, "")
    return F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.conv(F.substring(hexes, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _pick(letters: str, byte: Column) -> Column:
    return F.substring(F.lit(letters), byte % len(letters) + 1, F.lit(1))


def _same_format(text: Column, stream: Column, digits: str = "0123456789", lower: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """The text with every ASCII digit and letter replaced by one of its kind."""

    def draw(c: Column, byte: Column) -> Column:
        return (
            F.when(c.between("0", "9"), _pick(digits, byte)).when(c.between("a", "z"), _pick(lower, byte))
            .when(c.between("A", "Z"), _pick(lower.upper(), byte)).otherwise(c)
        )

    return F.array_join(F.zip_with(_characters(text), stream, draw), "")


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern fits the whole entity; what fits none but stood after an assignment is a secret.
    Long numbers without a card's check digit are just numbers."""
    kind = F.when(entity.rlike(f"^(?:{PATTERNS['person']})$"), F.lit("person")).otherwise(F.lit("secret"))
    for name in reversed([k for k in PATTERNS if k not in ("secret", "person")]):
        found = F.when(_card(entity), F.lit(name)).otherwise(F.lit("number")) if name == "card" else F.lit(name)
        kind = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), found).otherwise(kind)
    return kind


#: What card numbers begin with, by their length, before a check digit that one number in ten has by chance.
CARDS = (
    "4[0-9]{12}(?:[0-9]{3}){0,2}", "5[1-5][0-9]{14}", "2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}",
    "3[47][0-9]{13}", "3(?:0[0-5]|[689][0-9])[0-9]{11}", "(?:35|62|65|6011|64[4-9])[0-9]{12,17}",
)


def _card(entity: Column) -> Column:
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return F.length(digits).between(13, 19) & digits.rlike(f"^(?:{'|'.join(CARDS)})$") & F.call_function("luhn_check", digits)


def _person(entity: Column) -> tuple[Column, Column]:
    """Title and the words of the name."""
    pattern = rf"^({_TITLE}\.?) (.+)$"
    return F.regexp_extract(entity, pattern, 1), F.split(F.regexp_extract(entity, pattern, 2), " ")


def _units(entities: DataFrame) -> DataFrame:
    """(entity, kind, at, unit_kind, norm): what gets a surrogate of its own. A person's words are units, given names
    by gender, so that a family name alone leads to the same person."""
    title, words = _person(F.col("entity"))
    female = F.lower(F.regexp_replace(title, r"\.$", "")).isin(*[t.lower() for t in FEMALE])
    given = F.when(female, F.lit("given_f")).otherwise(F.lit("given_m"))
    of_person = F.transform(
        words, lambda w, i: F.struct(i.alias("at"), F.when(i < F.size(words) - 1, given).otherwise(F.lit("family")).alias("unit_kind"), F.lower(w).alias("norm"))
    )
    digits = F.regexp_replace("entity", "[^0-9+]", "")
    norm = (
        F.when(F.col("kind") == "email", F.lower("entity")).when(F.col("kind").isin("phone", "card", "ssn"), digits)
        .when(F.col("kind") == "iban", F.regexp_replace("entity", " ", "")).otherwise(F.col("entity"))
    )
    alone = F.array(F.struct(F.lit(0).alias("at"), F.col("kind").alias("unit_kind"), norm.alias("norm")))
    parts = F.when(F.col("kind") == "person", of_person).otherwise(alone)
    return entities.select("entity", "kind", F.explode(parts).alias("u")).select("entity", "kind", "u.at", "u.unit_kind", "u.norm")


def drawn(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a unit, in its plain form."""
    stream = _stream(key, attempt, kind, norm, length=F.length(norm) + attempt + 8)
    same = _same_format(norm, stream)
    # what a unit gets at its end where its format has no room left: letters, or digits where it has digits alone
    spare = F.slice(stream, F.length(norm) + 1, F.greatest(attempt - (IN_FORMAT - 1), F.lit(0)))
    letters = F.array_join(F.transform(spare, lambda b: _pick("abcdefghijklmnopqrstuvwxyz", b)), "")
    figures = F.array_join(F.transform(spare, lambda b: _pick("0123456789", b)), "")
    extra = F.when(kind.isin("email", "secret"), letters).when(kind == "access_key", F.upper(letters)).otherwise(figures)
    at = F.instr(norm, "@")
    local = F.substring(norm, F.lit(1), at - 1)
    domain = F.substring(F.sha2(F.concat_ws("\u0001", F.lit(key), F.substring(norm, at + 1, F.length(norm))), 256), 1, 8)
    email = F.concat(_same_format(local, F.slice(stream, F.lit(1), F.length(local))), extra, F.lit("@mail"), domain, F.lit(".example.com"))
    octets = F.transform(F.slice(stream, 1, 4), lambda b: (b % 254 + 1).cast("string"))
    ip = F.concat((F.element_at(stream, 5) % 223 + 1).cast("string"), F.lit("."), F.array_join(F.slice(octets, 2, 3), "."))
    # the country code's first digit stays; the first four digits of a card, its issuer's, stay, and its check digit fits
    phone = F.when(norm.startswith("+"), F.concat(F.substring(norm, 1, 2), F.substring(same, F.lit(3), F.length(norm)))).otherwise(same)
    body = F.concat(F.substring(norm, 1, 4), F.substring(same, F.lit(5), F.length(norm) - 5))
    fitting = F.filter(F.array(*[F.concat(body, F.lit(str(d))) for d in range(10)]), lambda c: F.call_function("luhn_check", c))
    card = F.when(F.call_function("luhn_check", norm), F.element_at(fitting, 1)).otherwise(F.concat(F.substring(norm, 1, 1), F.substring(same, F.lit(2), F.length(norm))))
    iban = F.concat(F.substring(norm, 1, 2), F.substring(same, F.lit(3), F.length(norm)))
    access = F.concat(F.lit("AKIA"), F.substring(same, 5, 16))
    secret = F.when(norm.rlike("^[0-9a-f]+$"), _same_format(norm, stream, "0123456789abcdef", "0123456789abcdef")).otherwise(same)
    value = same
    for name, column in (("email", email), ("ip", ip), ("phone", phone), ("card", card), ("iban", iban), ("access_key", access), ("secret", secret)):
        value = F.when(kind == name, column).otherwise(value)
    dotted = F.array_join(F.transform(spare, lambda b: F.concat(F.lit("."), (b % 254 + 1).cast("string"))), "")
    value = F.when(kind == "email", value).when(kind == "ip", F.concat(value, dotted)).otherwise(F.concat(value, extra))
    for script, test in (("Latin", F.lit(True)), ("Greek", norm.rlike(r"\p{IsGreek}")), ("Cyrillic", norm.rlike(r"\p{IsCyrillic}"))):
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        # a draw that was repeated has a syllable more, so there is always room
        stem = F.array_join(F.transform(F.slice(stream, F.lit(1), attempt + 2), lambda b: F.element_at(syllables, b % len(SYLLABLES[script]) + 1)), "")
        for name, endings in ENDINGS[script].items():
            ending = F.element_at(F.array(*map(F.lit, endings)), F.element_at(stream, -1) % len(endings) + 1)
            value = F.when((kind == name) & test, F.concat(stem, ending)).otherwise(value)
    return value


def unit_surrogates(units: DataFrame, key: str) -> DataFrame:
    """(unit_kind, norm, surrogate) for distinct units (unit_kind, norm): different surrogates for different units,
    none of which is itself a unit."""
    attempt = F.col("attempt")
    found = staged(units.select("unit_kind", "norm").distinct().withColumn("attempt", F.lit(0)), "units")
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(MAX_DRAWS):
        # units are small and drawing takes time: a small table is no reason for a single task
        table = staged(found.repartition(tasks, "unit_kind", "norm").withColumn("surrogate", drawn(F.col("unit_kind"), F.col("norm"), attempt, key)), "draws")
        # of equal draws the first unit keeps its own
        first = table.groupBy("unit_kind", "surrogate").agg(F.min("norm").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1")
        real = table.select("unit_kind", F.col("norm").alias("surrogate"), F.lit(True).alias("is_real"))
        judged = table.join(first.drop("n"), ["unit_kind", "surrogate"], "left").join(real, ["unit_kind", "surrogate"], "left")
        clash = F.coalesce(F.col("holder") != F.col("norm"), F.lit(False)) | F.col("is_real").isNotNull()
        again = judged.where(clash).select("unit_kind", "norm", F.lit(True).alias("again"))
        if again.isEmpty():
            return table.drop("attempt")
        found = staged(
            table.join(staged(again, "clashes"), ["unit_kind", "norm"], "left")
            .select("unit_kind", "norm", F.when(F.col("again"), attempt + 1).otherwise(attempt).cast("int").alias("attempt")),
            "units",
        )
    raise ValueError(f"no distinct surrogates after {MAX_DRAWS} draws: too many entities for their format")


def entity_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(entity, replacement) for distinct entities: the units' surrogates, written as the entity is; plain numbers stay."""
    known = entities.withColumn("kind", kind_of(F.col("entity")))
    units = _units(known.where("kind <> 'number'"))
    joined = units.join(unit_surrogates(units, key), ["unit_kind", "norm"])
    whole = joined.groupBy("entity", "kind").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("parts"))
    plain = F.col("parts")[0]["surrogate"]
    title, words = _person(F.col("entity"))
    cased = F.zip_with(
        words, F.col("parts"), lambda w, p: F.when((F.upper(w) == w) & (F.length(w) > 1), F.upper(p["surrogate"])).otherwise(F.initcap(p["surrogate"]))
    )
    symbols = F.when(F.col("kind") == "phone", F.regexp_replace(plain, r"\+", "")).otherwise(plain)
    replaced = F.when(F.col("kind") == "iban", F.lit("[A-Z0-9]")).otherwise(F.lit("[0-9]"))
    # each digit (or letter) of the entity gives way to the next of the surrogate
    formatted = F.aggregate(
        _characters(F.col("entity")),
        F.struct(F.lit(0).alias("i"), F.lit("").alias("out")),
        lambda s, c: F.when(F.regexp_like(c, replaced), F.struct((s["i"] + 1).alias("i"), F.concat(s["out"], F.substring(symbols, s["i"] + 1, F.lit(1))).alias("out")))
        .otherwise(F.struct(s["i"].alias("i"), F.concat(s["out"], c).alias("out"))),
        # a surrogate that is longer than its entity's format goes on after it
        lambda s: F.concat(s["out"], F.substring(symbols, s["i"] + 1, F.length(symbols))),
    )
    upper = (F.col("kind") == "email") & (F.upper("entity") == F.col("entity"))
    written = (
        F.when(F.col("kind") == "person", F.concat(title, F.lit(" "), F.array_join(cased, " ")))
        .when(F.col("kind").isin("phone", "card", "ssn", "iban"), formatted).when(upper, F.upper(plain)).otherwise(plain)
    )
    numbers = known.where("kind = 'number'").select("entity", F.col("entity").alias("replacement"))
    return whole.select("entity", written.alias("replacement")).unionByName(numbers)


def replace_entities(docs: DataFrame, key: str, text: str = "text", count: str = "n_entities") -> DataFrame:
    """``docs`` with surrogates in the text column, and the number of entities replaced (``count``, renamed by
    underscores if ``docs`` has such a column).

    Null texts stay null (0 entities), empty texts and those without entities stay as they are. Repeated rows and
    texts get the same surrogates; other columns pass through. An empty table gives an empty table. The same key gives the same
    surrogates on the same texts.
    """
    column, n = quoted(text), fresh(docs.columns, count)
    # plain searches first: they are far cheaper than the patterns
    plain = F.lower(column)
    hint = F.coalesce(reduce(Column.__or__, [plain.contains(word) for word in HINTS], column.rlike("[0-9@]")), F.lit(False))
    # texts by their digest: copies are looked at once. The patterns run once over every text with a hint, and once more
    # to split those that have an entity
    digest = F.md5(column.cast("binary"))
    with_any = docs.where(hint).select(digest.alias("digest"), F.regexp_extract_all(column, F.lit(ENTITY), F.lit(0)).alias("entities"))
    found = staged(with_any.where(F.size("entities") > 0).groupBy("digest").agg(F.max("entities").alias("entities")), "entities")
    replacements = entity_surrogates(found.select(F.explode("entities").alias("entity")).distinct(), key)
    placed = found.select("digest", F.posexplode("entities").alias("at", "entity")).join(staged(replacements, "replacements"), "entity")
    by_text = placed.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct("at", "replacement"))).alias("parts"),
        F.sum((F.col("replacement") != F.col("entity")).cast("int")).cast("int").alias("n"),
    )
    own = []
    for name in ("_digest", "_parts", "_number"):
        own.append(fresh([*docs.columns, n, *own], name))
    by_text = by_text.select(F.col("digest").alias(own[0]), F.col("parts")["replacement"].alias(own[1]), F.col("n").alias(own[2]))
    # what lies between the entities (an array of one, so that the text is split once), and after each but the last its surrogate
    between = F.array(F.split(column, ENTITY, -1))

    def put_together(parts: Column) -> Column:
        filled = F.zip_with(F.slice(parts, F.lit(1), F.size(quoted(own[1]))), quoted(own[1]), lambda a, b: F.concat(a, b))
        return F.concat(F.array_join(filled, ""), F.element_at(parts, -1))

    rebuilt = F.element_at(F.transform(between, put_together), 1)
    changed = docs.where(hint).join(by_text, digest == quoted(own[0]), "left")
    kept, hit = [quoted(c) for c in docs.columns], quoted(own[0]).isNotNull()
    new = [F.when(hit, rebuilt).otherwise(quoted(c)).alias(c) if c == text else quoted(c) for c in docs.columns]
    return changed.select(*new, F.coalesce(quoted(own[2]), F.lit(0)).alias(n)).unionByName(docs.where(~hint).select(*kept, F.lit(0).alias(n)))
