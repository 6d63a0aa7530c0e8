"""Surrogates for personal data: keyed, consistent replacements of the same kind.

Entities are marked in one scan over a text, kind by kind, and a kind's pattern runs only over texts that hold what any such entity
must hold (an ``@``, a digit, a title). Marked texts are written as a table, and from there on no text is searched again.

An entity's surrogate is drawn from a keyed digest of its kind and canonical form: letters become letters of the
same case, digits digits, separators stay (but for passwords, whose symbols are drawn too), card numbers and IBANs stay
valid, a key keeps its prefix. A person keeps title, gender and script. Given and family names are entities of their own, so
Mr. John Smith and Mr. Smith share a family name; and what a title has made known in a text is replaced there
without one too: John Smith, JOHN SMITH, Smith's. The draw depends on nothing but key and entity, so all
mentions in all documents agree, and no table of mentions is needed to rewrite a text.

Two entities could draw one surrogate, or a surrogate could be an entity that occurs. So the distinct
entities are checked against each other: whoever comes later draws again until all differ. After some draws
surrogates grow longer, so no kind runs out of them.
Those few redraws, and only the texts that mention them, are joined.

Only DataFrame functions are used. All patterns are bounded or possessive, so time grows with the length of a text, whatever it holds. A local
part of an address is 64 characters long at most, and a label of its host 63, as mail itself demands.

Nulls: a null text stays null with 0 entities; a null id is kept. Repeated rows are rewritten alike. An
empty table gives no rows. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import KeyFilter, join_by_size

_NAME = r"\p{Lu}[\p{L}'’-]++"
_TITLE = r"(?:Mrs?|Ms|Miss|Herr|Frau|Mme|Monsieur|Madame|Señora?|Sra?|г-н|г-жа)\.?"
# Patterns by kind. Where several could start at one place, the first counts.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "password": r"(?<=password=)[^\s\"'\x01]++",
    "hex_token": r"(?<=\")[0-9a-f]{32,64}(?=\")",
    "ip": r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    # North American, then any country's groups of two to four digits (15 digits at most, E.164); national ones without a country code.
    "phone": r"(?<!\w)(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}"
             r"|\+(?=(?:[ .()-]{0,3}\d){8,15}(?!\w))\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,5}"
             r"|(?:1[ .-])?\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<!-)(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?!-)"
             r"|0\d(?:[ .-]\d\d){4}|0\d{2,4}[ .-]\d{3,4}[ .-]\d{3,4}|[6-9]\d\d(?: \d\d){3})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "cloud_key": r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)",
    "person": rf"(?<!\p{{L}}){_TITLE} {_NAME}(?: {_NAME})?",
    # Capitalised words; those that a title has made known are a person's.
    "name": rf"(?<!\p{{L}})\p{{Lu}}[\p{{L}}'’-]*+(?: \p{{Lu}}[\p{{L}}'’-]*+)*+",
}
KINDS = list(PATTERNS)
# What a text must hold, what an entity starts with, and the kinds that are looked for together.
STAGES = [
    (lambda t: t.contains("@"), "[\x01A-Za-z0-9]", ["email"]),
    (lambda t: t.contains("password=") | t.rlike("\"[0-9a-f]{32}"), "", ["password", "hex_token"]),
    (lambda t: t.rlike("[0-9]{2}|[0-9][.][0-9]|AKIA"), "[\x01+(0-9A-Z]", ["ip", "ssn", "phone", "iban", "card", "cloud_key"]),
    (lambda t: t.rlike(rf"(?=[MHFSг]){_TITLE} \p{{Lu}}"), "[\x01MHFSг]", ["person"]),
    (lambda t: t.contains(SEPARATOR + chr(97 + KINDS.index("person"))), "", ["name"]),
]
FEMALE_TITLES = r"^(?:Mrs|Ms|Miss|Frau|Mme|Madame|Señora|Sra|г-жа)\b"
# Parts of made-up names by script: beginnings, middles, then ends of female and male given names and of family names.
SYLLABLES = {
    "latin": ("Al Ber Cor Dan El Fer Gal Han Is Jor Kal Lor Mar Nor Or Pal Ros Sal Tor Ul Val Wer Yol Zan".split(),
              "a e i o an en in on ar er ir or al el il ol am em im om".split(), "da la na ra sa ta va lina rina dora".split(), "do lo no ro so to vo lin rin dor".split(),
              "ck den ger holt kamp ler man ner sen ton vik ward ridge wood stein berg ford ley mont well".split()),
    "cyrillic": ("Бел Вол Гром Дуб Еф Жар Зим Игн Кар Лам Мор Ник Ор Пав Род Сав Тим Уш Фед Хар Чер Шам Юд Яр".split(),
                 "а е и о ан ен ин он ар ер ир ор ал ел ил ол ам ем им ом".split(), "на ла ра ся ня мила слава рина дора лина".split(), "н л р м с мир слав рин дор лин".split(),
                 "ов ев ин".split()),
}
# A mark is SEPARATOR, a field a kind (a letter and the form), set off by FIELD, SEPARATOR. ESCAPE and what follows it stand for either in a text.
# None of these counts as a letter, digit, space or quote.
SEPARATOR, ESCAPE = "\1", "\2"
FIELD = ESCAPE + "\5"
# Country codes keep their length however a number is spaced.
COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
# From this draw on, a surrogate is one character (a name, one syllable) longer at each draw, so there is always a free one.
LONGER_FROM = 4
# What stands in for a password's characters, by class; the first class that fits counts.
CLASSES = {
    r"\p{Nd}": "0123456789", r"[\p{IsCyrillic}&&\p{Lu}]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ", r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшщэюя",
    r"\p{Lu}": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"\p{L}": "abcdefghijklmnopqrstuvwxyz", "": "!#$%&*+-.:;=?@^_~",
}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not at each place that names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _luhn_sum(digits: Column) -> Column:
    """Luhn's weighted sum, the last digit counting once."""
    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int"))), F.lit(0), lambda a, x: a + x)


def mark_entities(rows: DataFrame, text: str, marked: str) -> DataFrame:
    """Adds ``marked``: the text with its entities set off, or null where there are none."""
    plain = F.replace(F.replace(F.col(text), F.lit(ESCAPE), F.lit(ESCAPE + "\4")), F.lit(SEPARATOR), F.lit(ESCAPE + "\3"))
    rows = rows.withColumn(marked, plain)
    for needs, first, kinds in STAGES:
        # Marks of earlier stages are stepped over.
        pattern = "|".join(["(\x01[^\x01]*+\x01)", *[f"({PATTERNS[k]})" for k in kinds]])
        fields = FIELD.join(f"{chr(97 + KINDS.index(k))}${n}" for n, k in enumerate(kinds, 2))
        found = F.regexp_replace(F.col(marked), f"(?={first})(?:{pattern})" if first else pattern, "$1" + SEPARATOR + fields + SEPARATOR)
        rows = rows.withColumn(marked, F.when(needs(F.col(marked)), found).otherwise(F.col(marked)))
    return rows.withColumn(marked, F.when(F.col(marked).contains(SEPARATOR), F.col(marked)))


def _core(word: Column) -> Column:
    """A name without the ending of a possessive."""
    return F.regexp_replace(word, "['’][sS]$", "")


def _name_kind(given: Column, female: Column, word: Column) -> Column:
    script = F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    gender = F.when(female, "f").otherwise("m")
    # Only Cyrillic family names have a gender.
    return F.concat_ws(".", F.when(given, "given").otherwise("family"), script, F.when(given | (script == "cyrillic"), gender))


def _names(form: Column) -> Column:
    """word, form, kind and is_given of the names of a person with a title."""
    def of(words: Column) -> Column:
        one = lambda word, given: F.struct(F.lower(_core(word)).alias("word"), _core(word).alias("form"), _name_kind(F.lit(given), form.rlike(FEMALE_TITLES), word).alias("kind"), F.lit(given).alias("is_given"))
        family = one(F.element_at(words, -1), False)
        return F.when(F.size(words) > 2, F.array(one(F.get(words, F.lit(1)), True), family)).otherwise(F.array(family))

    return _let(F.split(form, " "), of)


def read_marks(marked: Column) -> tuple[Column, Column]:
    """(marks, known): the text in order as an array of kind and form, null kinds being text; and the names that titles have made known."""
    restored = lambda s: F.replace(F.replace(s, F.lit(ESCAPE + "\3"), F.lit(SEPARATOR)), F.lit(ESCAPE + "\4"), F.lit(ESCAPE))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def mark(piece: Column, i: Column) -> Column:
        field = F.get(F.filter(F.split(piece, FIELD), lambda f: F.length(f) > 1), F.lit(0))
        kind, form = F.get(kinds, F.ascii(field) - 97), restored(F.substr(field, F.lit(2)))
        # Digits that are no card number stay text.
        no_card = F.when(kind == "card", _luhn_sum(F.regexp_replace(form, "[^0-9]", "")) % 10 != 0).otherwise(False)
        entity = F.struct(F.when(no_card, F.lit(None)).otherwise(kind).alias("kind"), F.coalesce(form, F.lit("")).alias("form"))
        return F.when(i % 2 == 1, entity).otherwise(F.struct(F.lit(None).cast("string").alias("kind"), restored(piece).alias("form")))

    marks = F.filter(F.transform(F.split(marked, SEPARATOR), mark), lambda m: m["form"] != "")
    known = F.array_distinct(F.flatten(F.transform(F.filter(marks, lambda m: m["kind"] == "person"), lambda m: _names(m["form"]))))
    return marks, known


def _is_family(known: Column, word: Column) -> Column:
    return F.exists(known, lambda k: ~k["is_given"] & (k["word"] == F.lower(_core(word))))


def only_known(marks: Column, known: Column) -> Column:
    """Capitalised words of no one known become text again."""
    def one(m: Column) -> Column:
        named = F.when(m["kind"] == "name", F.exists(F.split(m["form"], " "), lambda w: _is_family(known, w))).otherwise(True)
        kind = F.when(m["kind"] == "name", F.lit("person")).otherwise(m["kind"])
        return F.struct(F.when(named, kind).alias("kind"), m["form"].alias("form"))

    return F.transform(marks, one)


def pieces_of(marks: Column, known: Column) -> Column:
    """Marks with persons taken apart: kind, form, whether the form is in capitals, and the text that follows it."""
    plain = lambda kind, form: F.struct(kind.alias("kind"), form.alias("form"), F.lit(False).alias("upper"), F.lit("").alias("tail"))

    def words(words: Column) -> Column:
        def piece(w: Column, core: Column, i: Column) -> Column:
            before_family = _is_family(known, F.coalesce(F.get(words, i + 1), F.lit("")))
            mine = F.filter(known, lambda k: (k["word"] == F.lower(core)) & (~k["is_given"] | before_family))
            # Before a family name a given name is meant, if both are known.
            kind = F.element_at(F.array_sort(F.transform(mine, lambda k: F.struct((~k["is_given"]).alias("family"), k["kind"].alias("kind")))), 1)["kind"]
            end = F.when(i + 1 < F.size(words), " ").otherwise("")
            return F.when(F.size(mine) == 0, plain(F.lit(None).cast("string"), F.concat(w, end))).otherwise(
                F.struct(kind.alias("kind"), core.alias("form"), ((F.length(core) > 1) & (core == F.upper(core))).alias("upper"), F.concat(F.substr(w, F.length(core) + 1), end).alias("tail")))

        return F.transform(words, lambda w, i: _let(_core(w), lambda core: piece(w, core, i)))

    return F.flatten(F.transform(marks, lambda m: F.when(m["kind"] == "person", _let(F.split(m["form"], " "), words)).otherwise(F.array(plain(m["kind"], m["form"])))))


def canonical(kind: Column, form: Column) -> Column:
    """What all forms of an entity share: digits of numbers, letters without case or spacing."""
    digits = F.regexp_replace(form, "[^0-9]", "")
    return (F.when(kind.isin("ssn", "card"), digits).when(kind == "phone", F.concat(F.when(form.rlike(r"^(?:\+|1[ .-])"), "+").otherwise(""), digits))
            .when(kind == "email", F.lower(form)).when(kind == "iban", F.regexp_replace(form, " ", ""))
            .when(kind.startswith("given.") | kind.startswith("family."), F.lower(form)).otherwise(form))


def _bytes(*parts: Column | str) -> Column:
    """128 keyed bytes as an array of ints."""
    seed = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    hexes = F.concat(*[F.sha2(F.concat(seed, F.lit(f"|{i}")), 256) for i in range(4)])
    return F.transform(F.sequence(F.lit(0), F.lit(127)), lambda i: F.conv(F.substr(hexes, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))


def _redraw(form: Column, noise: Column, keep: Column | int = 0, letters: bool = True) -> Column:
    """Each letter and digit of ``form`` after the first ``keep`` replaced within its class; the rest stays.

    The n-th letter or digit takes the n-th byte, so spacing doesn't change what is drawn.
    """
    kept = keep if isinstance(keep, Column) else F.lit(keep)

    def one(c: Column, i: Column) -> Column:
        b = F.element_at(noise, (F.pmod(i, F.lit(128)) + 1).cast("int"))
        shift = lambda first, count: F.char(F.lit(ord(first)) + b % count)
        out = F.when(i < kept, c).when(c.between("0", "9"), shift("0", 10))
        if letters:
            out = out.when(c.between("a", "z"), shift("a", 26)).when(c.between("A", "Z"), shift("A", 26))
        return out.otherwise(c)

    def spaced(drawn: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

        def step(s: Column, c: Column) -> Column:
            real = c.between("0", "9") | c.between("a", "z") | c.between("A", "Z")
            return F.struct(F.concat(s["out"], F.when(real, F.get(drawn, s["n"])).otherwise(c)).alias("out"), (s["n"] + real.cast("int")).alias("n"))

        return F.aggregate(F.split(form, ""), start, step, lambda s: s["out"])

    compact = F.regexp_replace(form, "[^A-Za-z0-9]", "")
    return F.when(compact == "", form).otherwise(_let(F.transform(F.split(compact, ""), one), spaced))


def _pick(names: list[str], b: Column) -> Column:
    return F.element_at(F.split(F.lit(" ".join(names)), " "), (b % len(names) + 1).cast("int"))


def _redraw_all(form: Column, noise: Column) -> Column:
    """Each character of ``form`` replaced within its class, symbols too."""
    def one(c: Column, i: Column) -> Column:
        b = F.element_at(noise, (F.pmod(i, F.lit(128)) + 1).cast("int"))
        out = F.lit(None).cast("string")
        for pattern, alphabet in reversed(CLASSES.items()):
            out = F.when(c.rlike(f"^{pattern}"), F.substr(F.lit(alphabet), (b % len(alphabet) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(form, ""), one), "")


def _longer(noise: Column, draw: Column) -> Column:
    """Digits to append: none before ``LONGER_FROM``, then one more at each draw."""
    tail = F.slice(F.reverse(noise), F.lit(1), F.greatest(F.lit(0), draw - (LONGER_FROM - 1)))
    return F.array_join(F.transform(tail, lambda b: (b % 10).cast("string")), "")


def _name(kind: Column, noise: Column, draw: Column) -> Column:
    """A made-up given or family name. Later draws have more syllables, so there is always another one to be had."""
    at = lambda k: F.element_at(noise, k)
    out = F.lit(None).cast("string")
    for script, (begins, middles, female, male, family) in SYLLABLES.items():
        more = F.transform(F.slice(noise, F.lit(8), F.floor(draw / 2).cast("int")), lambda b: _pick(middles, b))  # noqa: B023
        stem = F.concat(_pick(begins, at(1)), _pick(middles, at(2)), F.array_join(more, ""))
        given = lambda ends: F.concat(stem, F.lower(_pick(begins, at(3))), _pick(ends, at(4)))  # noqa: E731, B023
        last = F.concat(stem, F.lower(_pick(begins, at(3))), _pick(middles, at(5)), _pick(family, at(6)))
        out = (F.when(kind == f"given.{script}.f", given(female)).when(kind == f"given.{script}.m", given(male))
               .when(kind == f"family.{script}.f", F.concat(last, F.lit("а"))).when(kind.startswith(f"family.{script}"), last).otherwise(out))
    return out


def surrogate(kind: Column, form: Column, draw: Column, key: str) -> Column:
    """The surrogate that a form gets at a draw."""
    return _let(_bytes(key, kind, canonical(kind, form), draw.cast("string")), lambda noise: _drawn(kind, form, draw, key, noise))


def _drawn(kind: Column, form: Column, draw: Column, key: str, noise: Column) -> Column:
    host = F.regexp_extract(form, r"@(.+)\.[A-Za-z]+$", 1)
    top = F.regexp_extract(form, r"(\.[A-Za-z]+)$", 1)
    # Hosts are drawn on their own, so that addresses of one host keep one host.
    own_host = _let(_bytes(key, "host", F.lower(host)), lambda n: _redraw(host, n))
    longer = _longer(noise, draw)
    email = F.concat(_redraw(F.regexp_extract(form, "^([^@]+)@", 1), noise), longer, F.lit("@"), own_host, top)
    ip = F.concat_ws(".", *[(F.element_at(noise, k) % 254 + 1).cast("string") for k in range(1, 5)])
    # Four bytes can't be made longer: an address of the other length.
    groups = F.transform(F.sequence(F.lit(1), F.lit(7)), lambda k: F.lower(F.hex(F.element_at(noise, 2 * k) * 256 + F.element_at(noise, 2 * k + 1))))
    ip = F.when(draw < LONGER_FROM, ip).otherwise(F.concat(F.lit("fd00:"), F.array_join(groups, ":")))
    hexes = F.substr(F.array_join(F.transform(noise, lambda b: F.lower(F.lpad(F.hex(b), 2, "0"))), ""), F.lit(1), F.length(form))
    # A country code or a leading 0 stays.
    code = F.length(F.regexp_extract(canonical(kind, form), COUNTRY, 1))
    keep = F.when(kind == "phone", F.when(form.startswith("0"), 1).otherwise(code)).when(kind == "iban", 2).when(kind == "cloud_key", 4).when(kind == "card", 1).otherwise(0)
    plain = F.concat(_redraw(form, noise, keep), longer)
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", _let(plain, _with_check_digit)).when(kind == "iban", _let(plain, _with_iban_check))
            .when(kind == "hex_token", F.concat(hexes, longer)).when(kind.startswith("given.") | kind.startswith("family."), _name(kind, noise, draw))
            .when(kind == "password", F.concat(_redraw_all(form, noise), longer)).otherwise(plain))


def _with_check_digit(body: Column) -> Column:
    digits = F.regexp_replace(body, "[^0-9]", "")
    check = (10 - _luhn_sum(F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), F.lit("0"))) % 10) % 10
    return F.concat(F.substr(body, F.lit(1), F.length(body) - 1), check.cast("string"))


def _mod97(compact: Column) -> Column:
    """The remainder of digits and letters (A = 10) read as one number."""
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(compact, ""), F.lit(0), lambda a, c: ((a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int"))


def _with_iban_check(body: Column) -> Column:
    country, rest = F.substr(body, F.lit(1), F.lit(2)), F.substr(body, F.lit(5))
    check = 98 - _mod97(F.concat(F.regexp_replace(rest, "[^A-Z0-9]", ""), country, F.lit("00")))
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), rest)


def settle_draws(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, n, draw (> 0 only) of entities that had to draw again. entities, a table: distinct kind, canon, form, and n, the number of mentions."""
    spark = entities.sparkSession
    drawn = canonical(F.col("kind"), surrogate(F.col("kind"), F.col("form"), F.col("draw"), key))
    # Little data but much work for each row, so spread by number of rows.
    tasks = max(spark.sparkContext.defaultParallelism, entities.count() // 10_000)
    now = materialize(entities.repartition(tasks, "kind", "canon").withColumn("draw", F.lit(0)).withColumn("drawn", drawn), "pii-draws")
    taken = entities.select("kind", F.col("canon").alias("drawn"), F.lit(True).alias("real"))
    while True:  # surrogates grow, so this ends
        # Among those that drew alike, whoever drew first keeps it.
        rank = F.row_number().over(Window.partitionBy("kind", "drawn").orderBy("draw", "canon"))
        after = now.withColumn("rank", rank).join(taken, ["kind", "drawn"], "left")
        after = materialize(after.select("kind", "canon", "form", "n", "draw", "drawn", (F.coalesce("real", F.lit(False)) | (F.col("rank") > 1)).alias("again")), "pii-draws")
        again = after.filter("again")
        if again.isEmpty():
            return after.filter("draw > 0").select("kind", "canon", "n", "draw")
        again = again.withColumn("draw", F.col("draw") + 1).withColumn("drawn", drawn)
        now = materialize(after.filter("NOT again").unionByName(again).drop("again"), "pii-draws")


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, plus n_entities (long) and entity_kinds (array of kind names in order)."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("doc"), F.col(f"`{text_col}`").alias("body"))
    rows = mark_entities(rows.withColumn("row_key", F.xxhash64(f"doc.`{id_col}`", "body")), "body", "marked")
    rows = materialize(rows.withColumn("body", F.when(F.col("marked").isNull(), F.col("body"))), "pii-marked")

    marks, known = read_marks(F.col("marked"))
    found = rows.filter("marked IS NOT NULL").select("row_key", marks.alias("marks"), known.alias("known"))
    single = F.transform(F.filter("marks", lambda m: m["kind"].isNotNull() & ~m["kind"].isin("person", "name")), lambda m: F.struct(m["kind"].alias("kind"), m["form"].alias("form")))
    named = F.transform("known", lambda k: F.struct(k["kind"].alias("kind"), k["form"].alias("form")))
    mentions = found.select("row_key", F.explode(F.concat(single, named)).alias("mark")).select("row_key", "mark.*")
    mentions = materialize(mentions.withColumn("canon", canonical(F.col("kind"), F.col("form"))), "pii-mentions")
    entities = materialize(mentions.groupBy("kind", "canon").agg(F.min("form").alias("form"), F.count(F.lit(1)).alias("n")), "pii-entities")
    redrawn = materialize(settle_draws(entities, key), "pii-redrawn")
    # Texts that mention a redrawn entity; the others need no join.
    affected = join_by_size(mentions, redrawn, ["kind", "canon"], "n").groupBy("row_key").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "canon"), "draw"))).alias("draws"))
    affected = materialize(affected, "pii-affected")
    hits = KeyFilter(affected.select("row_key"), "row_key").mark(rows, F.col("row_key"))
    plain = hits.filter("NOT bm_hit").withColumn("draws", F.lit(None).cast("map<string,int>"))
    both = plain.unionByName(hits.filter("bm_hit").join(affected, "row_key", "left").select(*plain.columns))

    def put(e: Column) -> Column:
        draw = F.coalesce(F.element_at("draws", F.concat_ws("|", e["kind"], canonical(e["kind"], e["form"]))), F.lit(0))
        cased = lambda new: F.concat(F.when(e["upper"], F.upper(new)).otherwise(new), e["tail"])
        return F.when(e["kind"].isNull(), e["form"]).otherwise(_let(surrogate(e["kind"], e["form"], draw, key), cased))

    # Names are held by a variable: the optimizer would work them out anew at each mark.
    out = both.withColumn("marks", marks).withColumn("known", known).withColumn("marks", _let(F.col("known"), lambda k: only_known(F.col("marks"), k)))
    out = out.withColumn("pieces", _let(F.col("known"), lambda k: pieces_of(F.col("marks"), k)))
    kinds = F.filter(F.transform("marks", lambda e: e["kind"]), lambda k: k.isNotNull())
    out = out.withColumn("kinds", F.coalesce(kinds, F.array().cast("array<string>")))
    out = out.withColumn("new", F.when(F.col("marked").isNull(), F.col("body")).otherwise(F.array_join(F.transform("pieces", put), "")))
    columns = [F.col("new").alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns]
    return out.select(*columns, F.size("kinds").cast("long").alias("n_entities"), F.col("kinds").alias("entity_kinds"))
