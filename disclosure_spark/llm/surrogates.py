"""Personal data and secrets replaced by surrogates, in DataFrame functions only.

What is found gets a replacement of the same kind and format, derived from a key, the
kind and the value: a value has one surrogate in the whole corpus (coreference), and
rounds of collision checks see that no two values share one and that none is a real value.
A name found with a form of address is replaced wherever it recurs in the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh, saved

KEY = "surrogate-key-1"
ROUNDS = 16  # of collision checks before surrogates are told apart by a number

# Forms of address with the gender they tell, and given names.
_MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "κ"]
_FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "κα", "Mlle", "Mademoiselle", "Señorita", "Srta", "Fräulein"]
_NEUTRAL = ["Dr", "Prof", "Doctor", "Professor", "Doktor", "Docteur", "Mx", "д-р", "проф", "δρ"]
_GIVEN = {
    ("m", "Latin"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul"],
    ("f", "Latin"): ["Alma", "Bianca", "Clara", "Diana", "Emma", "Flora", "Helena", "Iris", "Julia", "Laura", "Maria", "Nora"],
    ("m", "Cyrillic"): ["Антон", "Борис", "Виктор", "Егор", "Иван", "Максим", "Олег", "Павел"],
    ("f", "Cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
    ("m", "Greek"): ["Αλέξης", "Γιώργος", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος"],
    ("n", "Latin"): ["Alex", "Charlie", "Eden", "Jamie", "Kim", "Quinn", "Robin", "Sascha"],
    ("n", "Cyrillic"): ["Валя", "Женя", "Саша", "Слава", "Шура"],
    ("n", "Greek"): ["Άρη", "Ντένη", "Φώτη", "Χάρη"],
    ("f", "Greek"): ["Άννα", "Ελένη", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία"],
}
_SYLLABLES = {
    "Latin": ["ba", "den", "fi", "gor", "hal", "jo", "ker", "lin", "mar", "nel", "ost", "per", "ran", "sel", "tor", "win"],
    "Cyrillic": ["ба", "вен", "гор", "до", "зим", "ка", "лин", "мор", "нов", "пет", "ров", "сел", "тар", "фе", "хо", "чен"],
    "Greek": ["βα", "γεν", "δη", "θε", "κα", "λαμ", "μα", "νι", "πα", "ρου", "σι", "ταρ", "φω", "χα", "ψι", "ζη"],
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join(sorted(_MALE + _FEMALE + _NEUTRAL, key=len, reverse=True))
_TITLES = rf"(?:(?:{_TITLE})\.? ){{1,4}}"
_NAME = r"\p{Lu}\p{L}+"
_SIGN = r"[\p{L}\p{M}\p{N}_.%+-]"  # of a mailbox
_TOP = r"\.(?:xn--[A-Za-z0-9-]+|\p{L}[\p{L}\p{M}]+)"
_HEX = r"[0-9A-Fa-f]{1,4}"
_BEGIN = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
_END = r"-----END [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
_MARK = r"-----(?:BEGIN|END) [A-Z ]{0,30}PRIVATE KEY"
_TOKEN = r"gh[opsru]_|github_pat_|glpat-|sk-|[rs]k_(?:live|test)_|xox[a-z]-|AIza|npm_|hf_|SG\."  # how access tokens begin
_PHONES = [
    # With the country; in groups of two to five digits from the trunk zero; in the North American form.
    r"(?<![\w+])(?:\+\d{1,3}|00[1-9]\d{0,2}[ .-])(?=(?:[ ./()-]{0,2}\d){6})[ ./-]?(?:\(\d{1,4}\) ?)?\d{1,4}(?:[ ./-]?\d{2,4}){1,5}(?!\d)",
    r"(?<![\w+.,(-])0\d(?:(?: \d{2}){4}|(?:\.\d{2}){4}|(?:-\d{2}){4})(?!\d)",
    r"(?<![\w+.,-])(?=(?:[ /()-]{0,2}\d){9})(?:\(0\d{1,4}\)[ /-]?|0\d{1,4}[ /-])\d{3,8}(?:[ -]\d{2,4}){0,3}(?!\d)",
    r"(?<![\w(])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
]
# By kind, in the order in which they are tried.
PATTERNS = {
    "email": rf"(?<!{_SIGN}){_SIGN}++@(?:[\p{{L}}\p{{M}}\p{{N}}-]++\.)*[\p{{L}}\p{{M}}\p{{N}}-]++{_TOP}",
    # To the mark that comes next, whatever the length; or plain lines without an end.
    "key": rf"{_BEGIN}(?:(?>[\s\S]*?(?={_MARK})){_END}|(?:\s{{1,4}}[A-Za-z0-9+/=]{{16,}}){{1,500}}+)",
    "jwt": r"(?<![\w-])eyJ[\w-]{5,}\.[\w-]{5,}\.[\w-]*",
    "token": rf"(?<![\w-])(?:{_TOKEN})[\w.-]*\w{{12,}}",
    "secret": r"(?<![A-Za-z])(?i:password|passwd|pwd|token|api[_-]?key|secret)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[\w/+.~-]{8,}"
    r"|(?<![A-Za-z])(?i:bearer) {1,3}(?!eyJ)(?=[\w/+.~-]{0,200}\d)[\w/+.~-]{16,}",
    "access": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": "|".join(_PHONES),
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ipv6": rf"(?<![\w:.])(?=[A-Fa-f:]{{0,40}}\d)(?=(?:{_HEX}:){{0,6}}:|(?:{_HEX}:){{6}})(?:(?:{_HEX})?:){{2,7}}(?:(?:{_OCTET}\.){{3}}{_OCTET}|{_HEX})?(?![\w:])",
    "ipv4": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)",
    "person": rf"(?<!\p{{L}}){_TITLES}{_NAME}(?:[ -]{_NAME})?",
}
# None of them starts behind a letter of a to z but with a digit or hyphen: most places are passed over at once.
PATTERN = r"(?:(?<![A-Za-z])|(?=[\d-]))(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
# Without a digit or one of these signs, the start of a key or token or a form of address, a text has none of the above.
_FIRSTS = "".join(sorted({t[0] for t in _MALE + _FEMALE + _NEUTRAL}))
_MAY = rf"[0-9@=:]|A(?:KI|SI)A[A-Z]|-----BEGIN |eyJ|{_TOKEN}|(?=[{_FIRSTS}])(?:{_TITLE})\.? \p{{Lu}}"


def _pick(options: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (F.pmod(n, F.lit(len(options))) + 1).cast("int"))


def _byte(i: Column) -> Column:
    """A number from 0 to 255 of the row's digest, by place (128 of them, then again)."""
    return F.conv(F.substring(F.col("digest"), (F.pmod(i, F.lit(128)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _luhn(digits: Column) -> Column:
    """The sum of card digits, every second one from the right doubled."""
    n = F.transform(F.split(F.reverse(digits), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    twice = lambda x: F.when(x > 4, x * 2 - 9).otherwise(x * 2)
    return F.aggregate(F.transform(n, lambda x, i: F.when(i % 2 == 1, twice(x)).otherwise(x)), F.lit(0), lambda s, x: s + x)


def _shaped(core: Column, hex_only: Column, fixed: Column) -> Column:
    """Each letter and digit beyond the first ``fixed`` by another of its kind."""

    def one(c: Column, i: Column) -> Column:
        n = _byte(i)
        code = F.ascii(c)
        at = lambda first, many: F.chr((F.lit(first) + F.pmod(n, F.lit(many))).cast("long"))
        return (
            F.when(i < fixed, c)
            .when(c.rlike("^[0-9]$"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike("^[a-z]$"), F.when(hex_only, at(97, 6)).otherwise(at(97, 26)))
            .when(c.rlike("^[A-Z]$"), F.when(hex_only, at(65, 6)).otherwise(at(65, 26)))
            .when(c.rlike(r"^\p{IsCyrillic}$"), _pick(list("абвгдежзиклмнопрстуфхцчшэюя"), n))
            .when(c.rlike(r"^\p{IsGreek}$"), _pick(list("αβγδεζηθικλμνξοπρστυφχψω"), n))
            .when(c.rlike(r"^\p{Lu}$"), at(65, 26))
            .when(c.rlike(r"^\p{L}$") & (code > 127), at(97, 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(core, ""), one), "")


def _spread(core: Column, signs: Column) -> Column:
    """``signs`` in the places of the letters and digits of ``core``."""
    before = lambda i: F.length(F.regexp_replace(F.substring(core, F.lit(1), (i + 1).cast("int")), "[^0-9A-Za-z]", ""))
    place = lambda c, i: F.when(c.rlike("^[0-9A-Za-z]$"), F.substring(signs, before(i), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(core, ""), place), "")


def _card(core: Column) -> Column:
    """As many digits in the same groups, the first kept, the last so that the sum is right."""
    plain = F.regexp_replace(core, "[^0-9]", "")
    body = F.transform(F.split(plain, ""), lambda c, i: F.when(i == 0, c).otherwise(F.pmod(_byte(i), F.lit(10)).cast("string")))
    body = F.array_join(F.slice(body, F.lit(1), F.length(plain) - 1), "")
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return _spread(core, F.concat(body, check))


def _iban(core: Column) -> Column:
    """The country kept, check digits that are right for the new number."""
    plain = F.regexp_replace(core, " ", "")
    country, body = F.substring(plain, 1, 2), _shaped(F.substring(plain, F.lit(5), F.length(plain)), F.lit(False), F.lit(0))
    number = F.transform(
        F.split(F.concat(body, country, F.lit("00")), ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)
    )
    rest = F.aggregate(F.split(F.array_join(number, ""), ""), F.lit(0), lambda r, c: F.pmod(r * 10 + F.coalesce(c.try_cast("int"), F.lit(0)), F.lit(97)))
    return _spread(core, F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), body))


def _named(kind: Column, attempt: int) -> Column:
    """A given name of the same gender and script, or a family name of the same script."""
    out = F.lit(None).cast("string")
    for (gender, script), names in _GIVEN.items():
        name = F.concat_ws("-", *[_pick(names, _byte(F.lit(i))) for i in range(1 + attempt // 2)])
        out = F.coalesce(out, F.when(kind == f"given-{gender}-{script}", name))
    for script, parts in _SYLLABLES.items():
        name = F.initcap(F.concat(*[_pick(parts, _byte(F.lit(i))) for i in range(3 + attempt // 4)]))
        out = F.coalesce(out, F.when(kind == f"family-{script}", name))
    return out


def _surrogate(kind: Column, core: Column, attempt: int) -> Column:
    """Reads the column ``digest``."""
    octets = F.concat_ws(".", *[(F.pmod(_byte(F.lit(i)), F.lit(254)) + 1).cast("string") for i in range(4)])
    tail = F.regexp_extract(core, rf"{_TOP}$", 0)
    mailbox = F.substring(core, F.lit(1), F.length(core) - F.length(tail))
    more = F.substring("digest", 1, 6) if attempt >= ROUNDS // 2 else F.lit("")
    email = F.concat(more, _shaped(mailbox, F.lit(False), F.lit(0)), tail)
    phone = _shaped(core, F.lit(False), F.length(F.regexp_extract(core, r"^(\+\d{1,3}[ .-]?|00\d{1,3}[ .-]|\(?0)?", 0)))
    # A short form has few others: from the fifth round on, an address in full.
    groups = F.concat_ws(":", F.concat(F.lit("fd"), F.substring("digest", 1, 2)), *[F.substring("digest", 4 * i, 4) for i in range(1, 8)])
    ipv6 = groups if attempt >= 4 else _shaped(core, F.lit(True), F.lit(0))
    end = F.regexp_extract(core, rf"\s*{_END}$", 0)
    inner = F.substring(core, F.lit(1), F.length(core) - F.length(end))
    return (
        F.when(kind == "email", email)
        .when(kind == "ipv4", octets)
        .when(kind == "ipv6", ipv6)
        .when(kind == "key", F.concat(_shaped(inner, F.lit(False), F.lit(0)), end))
        .when(kind == "jwt", _shaped(core, F.lit(False), F.lit(3)))
        .when(kind == "token", _shaped(core, F.lit(False), F.length(F.regexp_extract(core, rf"^(?:{_TOKEN})", 0))))
        .when(kind == "card", _card(core))
        .when(kind == "iban", _iban(core))
        .when(kind == "phone", phone)
        .when(kind == "access", _shaped(core, F.lit(False), F.lit(4)))
        .when(kind == "secret", _shaped(core, core.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(0)))
        .when(kind == "ssn", _shaped(core, F.lit(False), F.lit(0)))
        .otherwise(_named(kind, attempt))
    )


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "Cyrillic").when(name.rlike(r"\p{IsGreek}"), "Greek").otherwise("Latin")


def entity_parts(values: DataFrame) -> DataFrame:
    """What of each distinct ``value`` is replaced: rows of value, place, before, kind, core.

    ``before`` is text that stays, in front of the part. A number that looks like a card but has a wrong
    sum is none, and has no row.
    """
    kind = F.coalesce(*[F.when(F.col("value").rlike(f"^(?:{p})$"), k) for k, p in PATTERNS.items()])
    kinds = values.withColumn("kind", kind)
    lead = F.regexp_extract("value", r"^(?:\p{L}[\p{L}_-]*[\"']?\s*[=:]\s*[\"']?|(?i:bearer) +)", 0)
    begin = F.regexp_extract("value", rf"^{_BEGIN}\s*", 0)
    before = F.when(F.col("kind") == "secret", lead).when(F.col("kind") == "key", begin).otherwise("")
    whole = kinds.filter(F.col("kind") != "person").withColumn("before", before)
    whole = whole.withColumn("core", F.substring("value", F.length("before") + 1, F.length("value")))
    # A token is the same value with and without a name in front.
    for name in ("jwt", "token"):
        named = (F.col("kind") == "secret") & F.col("core").rlike(f"^(?:{PATTERNS[name]})$")
        whole = whole.withColumn("kind", F.when(named, name).otherwise(F.col("kind")))
    whole = whole.filter((F.col("kind") != "card") | (F.pmod(_luhn(F.regexp_replace("core", "[^0-9]", "")), F.lit(10)) == 0))
    whole = whole.select("value", F.lit(0).alias("place"), "before", "kind", "core")
    title = F.regexp_extract("value", rf"^{_TITLES}", 0)
    told = F.split(F.regexp_replace("before", r"\.? $", ""), r"\.? ")
    has = lambda titles: F.arrays_overlap(told, F.array(*map(F.lit, titles)))
    gender = F.when(has(_FEMALE), "f").when(has(_MALE), "m").otherwise("n")
    first, second = F.get("names", F.lit(0)), F.get("names", F.lit(1))
    sep = F.regexp_extract("rest", r"[ -]", 0)
    family = lambda n: F.concat(F.lit("family-"), _script(n))
    given = F.concat(F.lit("given-"), gender, F.lit("-"), _script(first))
    part = lambda i, b, k, c: F.struct(F.lit(i).alias("place"), b.alias("before"), k.alias("kind"), c.alias("core"))
    people = (
        kinds.filter(F.col("kind") == "person")
        .withColumn("before", title)
        .withColumn("rest", F.substring("value", F.length("before") + 1, F.length("value")))
        .withColumn("names", F.split("rest", "[ -]"))
        .withColumn(
            "parts",
            F.when(F.size("names") == 1, F.array(part(0, F.col("before"), family(first), first))).otherwise(
                F.array(part(0, F.col("before"), given, first), part(1, sep, family(second), second))
            ),
        )
        .select("value", F.explode("parts").alias("p"))
        .select("value", "p.*")
    )
    return whole.unionByName(people)


def dictionary(parts: DataFrame, key: str = KEY, name: str = "surrogates") -> DataFrame:
    """A surrogate for every distinct (kind, core), all distinct and none of them a real core.

    A candidate that another core also has goes to the least of them; the others,
    and those that met a real or a taken value, try again with the next digest.
    """
    real = saved(parts.select("kind", "core").distinct(), f"{name}_real")
    waiting, taken = real, None
    for attempt in range(ROUNDS):
        digest = F.concat(*[F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "core", F.lit(str(attempt)), F.lit(str(j))), 256) for j in range(4)])
        tried = waiting.withColumn("digest", digest).withColumn(
            "surrogate", _surrogate(F.col("kind"), F.col("core"), attempt)
        )
        tried = saved(tried.drop("digest"), f"{name}_{attempt}")
        blocked = real.select("kind", F.col("core").alias("surrogate"))
        if taken is not None:
            blocked = blocked.unionByName(taken.select("kind", "surrogate"))
        free = tried.join(blocked, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("core").alias("core"))
        won = saved(first.select("kind", "core", "surrogate"), f"{name}_{attempt}_won")
        taken = won if taken is None else taken.unionByName(won)
        waiting = saved(waiting.join(won, ["kind", "core"], "left_anti").select("kind", "core"), f"{name}_{attempt}_left")
        if waiting.isEmpty():
            return taken
    # What is left has a format with too few others: its last candidate and a number that no value has.
    turn = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("core"))
    return taken.unionByName(
        tried.join(waiting, ["kind", "core"], "left_semi").select("kind", "core", F.concat("surrogate", F.lit("-"), (turn + numbered(real, taken)).cast("string")).alias("surrogate"))
    )


def numbered(real: DataFrame, taken: DataFrame) -> Column:
    """The greatest number that ends a real or a taken value behind a hyphen, or 0: numbers above it are free."""
    ends = real.select("core").unionByName(taken.select(F.col("surrogate").alias("core")))
    last = F.regexp_extract("core", r"-(\d{1,17})$", 1).try_cast("long")
    return F.lit(ends.agg(F.coalesce(F.max(last), F.lit(0))).first()[0])


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and a last column ``n_entities``, how many were put in.

    All other columns stay as they are, but n_chars, if there, which is the new text's length. If ``docs`` has a column
    n_entities, it stays and the new one has a longer name. A null text stays null,
    an empty one empty, equal rows stay equal. An empty table gives an empty result.
    """
    count = fresh(docs, "n_entities")
    may = F.coalesce(F.col("text").rlike(_MAY), F.lit(False))
    print_, puts, many, again, gaps = (fresh(docs, c) for c in ("_print", "_puts", "_many", "_again", "_gaps"))
    # Of equal texts one is searched: results depend on the text alone.
    same = F.struct(F.xxhash64("text").alias("a"), F.hash("text").alias("b"), F.length("text").alias("c"))
    hits = docs.filter(may)
    found = hits.select(same.alias(print_), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found"))
    found = saved(found.filter(F.size("found") > 0).groupBy(print_).agg(F.max("found").alias("found")), "entities")
    spots = found.select(print_, F.posexplode("found").alias("spot", "value"))
    parts = saved(entity_parts(spots.select("value").distinct()), "entity_parts")
    names = dictionary(parts, key)
    piece = F.struct("place", F.concat("before", "surrogate").alias("piece"))
    person = F.when(F.col("kind").rlike("^(given|family)-"), F.struct("core", "surrogate"))
    values = parts.join(names, ["kind", "core"]).groupBy("value").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"), F.sort_array(F.collect_list(person)).alias("people")
    )
    values = saved(values.select("value", F.array_join("pieces.piece", "").alias("surrogate"), "people"), "entity_surrogates")
    placed = (
        spots.join(values, "value", "left")
        .groupBy(print_)
        .agg(
            F.sort_array(F.collect_list(F.struct("spot", F.coalesce("surrogate", "value").alias("put")))).alias(puts),
            F.count("surrogate").alias(many),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("people")))).alias("people"),
        )
        .withColumn("cores", F.array_distinct("people.core"))
        .withColumn("others", F.transform("cores", lambda c: F.get(F.filter("people", lambda p: p["core"] == c), F.lit(0))["surrogate"]))
        .select(print_, F.col(f"{puts}.put").alias(puts), many, F.map_from_arrays("cores", "others").alias(again))
    )
    placed = saved(placed, "entity_places")
    # What stands between the entities, cut into words where names may recur in it.
    cut = lambda t: F.split(t, r"(?<=\p{L})(?!\p{L})|(?<!\p{L})(?=\p{L})", -1)
    between = F.transform(F.split("text", PATTERN, -1), lambda t: F.when(F.size(again) > 0, cut(t)).otherwise(F.array(t)))
    recurs = F.aggregate(F.flatten(gaps), F.lit(0), lambda n, w: n + F.when(F.map_contains_key(again, w), 1).otherwise(0))
    named = lambda words: F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(again, w), w)), "")
    renamed = F.transform(gaps, lambda words: F.when(F.size(again) > 0, named(words)).otherwise(F.get(words, F.lit(0))))
    merged = F.array_join(F.flatten(F.zip_with(renamed, puts, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    changed = (
        hits.withColumn(print_, same)
        .join(placed, print_, "left")
        .withColumn(gaps, F.when(F.col(many) > 0, between))
        .withColumn("text", F.when(F.col(many) > 0, merged).otherwise(F.col("text")))
        .withColumn(count, F.coalesce(F.col(many) + F.when(F.size(again) > 0, recurs).otherwise(0), F.lit(0)).cast("long"))
        .drop(print_, puts, many, again, gaps)
    )
    out = changed.unionByName(docs.filter(~may).withColumn(count, F.lit(0).cast("long")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(count) > 0, F.char_length("text")).otherwise(F.col("n_chars")))
    return out
