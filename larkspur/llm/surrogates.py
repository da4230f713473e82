r"""PII surrogates: keyed, type-consistent replacements of detected entities (DataFrame functions only).

Detected are e-mail addresses, phone (international, North American, national with a leading 0, Spanish, bare ten digits), card and social security numbers, IPv4 addresses, access keys, values of
password / token / secret assignments, names after a title and their repeats in the document.  An entity's unit (lower-cased address, digits of a
number, word of a name with its role) is replaced by a surrogate drawn from SHA-256 of (key, type, unit, attempt):

* numbers keep length, punctuation, country code, trunk digit or first digit; cards get a valid check digit, IPv4 addresses go to
  10/8 (after four collisions to 240/4), social security numbers to the unassigned 9xx area;
* addresses keep the shape of the local part and end in example.com; secrets keep character classes (hex stays hex)
  and, after three collisions, grow longer;
* given names follow the person's gender (of the title, or else of another mention in the document), surnames the
  script (Latin or Cyrillic, with gendered Cyrillic endings); a name has any number of parts, particles stay; a part is
  replaced alike with or without the others, and also where the document repeats it without a title (if longer than
  one letter).

Equal units get equal surrogates in all documents (coreference).  Distinct units of a type get distinct surrogates,
none of which is itself a unit found in the corpus: collisions are found by grouping the surrogates, all but the first
draw again, until none is left (more than ``ROUNDS`` rounds mean a type with more units than surrogates: an error,
never a shared surrogate).  Documents without an entity never move; the others meet the surrogates of their own
units.  An entity in a third of all documents is one row a document, joined by its unit (adaptive execution splits it).

Results for odd input: a null text stays null with 0 entities, an empty one empty; repeated rows are replaced alike;
a text that is one long run is read whole; further columns are kept, ``n_entities`` and ``entity_types`` are added
(replacing columns of these names); an empty table gives an empty result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

KEY = "larkspur-surrogates"
ROUNDS = 100
#: Titles by gender (fixed values).
MALE = ("Mr", "Sir", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Don", "г-н", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "г-жа", "госпожа")
NEUTRAL = ("Dr", "Prof", "д-р")
_TITLES = "|".join(MALE + FEMALE + NEUTRAL)
#: Lower-case words inside a name; they stay as they are.
_PARTICLES = "von|vom|van|der|den|de|du|di|da|do|dos|das|del|della|des|la|las|le|los|zu|zum|zur|ter|ten|bin|ibn|el|al|af|av|y|e"
_SECRET_WORD = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key"

# Of any length and script, with apostrophes; each run of such characters is read once, from its start to its end.
_LOCAL = r"\p{L}\p{M}\p{N}._%+'’-"
EMAIL = rf"(?<![{_LOCAL}])[{_LOCAL}]++@[\p{{L}}\p{{M}}\p{{N}}-]++(?:\.[\p{{L}}\p{{M}}\p{{N}}-]++)++"
# What stands before the key word (db_, client-) stays as it is; the value is read to its end, without going back.
# After a colon, `secret` and `token` may be plain prose, so there a value needs six characters; else any will do.
SECRET = (rf"(?i:{_SECRET_WORD})[\"']?[ \t]{{0,3}}(?:=|(?<!(?i:secret|token)[\"' \t]{{0,4}}):|:(?=[ \t]{{0,3}}[\"']?[^\s\"',;]{{6}}))"
          r"[ \t]{0,3}[\"']?[^\s\"',;]++")
ACCESS = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
# A further digit of a phone, at most three separators on; a card number after a space is not part of it.
_MORE = r"(?:(?! (?:\d{4}[ -]?){3}\d)[ ().\-/]{0,3}\d)"
#: ITU country codes.
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
# International (+ or 00; +1 has ten digits more), then the North American grouping.
PHONE = (rf"(?<![\w+.-])(?:\+1{_MORE}{{10}}(?!\d)|(?:\+|00[ -]?)[1-9]{_MORE}{{7,14}}(?!\d)"
         r"|(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d))")
CARD = r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"
IP = r"(?<![\w.-])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\w-]|\.\d)"
# National forms: a leading 0 (not before a date), nine digits from 6 on (Spain), ten bare digits or 1 and ten.
_DATE = r"\d{1,2}[ ./-]\d{1,2}[ ./-](?:19|20)\d\d(?!\d)"
LOCAL = (rf"(?<![\w+.-])(?:(?!{_DATE})(?:\(0[1-9]|0[ -]?[1-9]){_MORE}{{6,10}}(?!\d)"
         r"|(?:[6-9]\d{8}|[6-9]\d\d[ -]\d{3}[ -]\d{3}|[6-9]\d\d[ .-]\d\d[ .-]\d\d[ .-]\d\d|[89]\d[ .-]\d{3}[ .-]\d\d[ .-]\d\d|1?\d{10})(?![\w-]|\.\d))")
# A part is a capitalised word with inner capitals, hyphens and apostrophes (not a closing 's), or an initial before another part.
_PART = (r"(?:(?:\p{Ll}{1,5}['’-])?\p{Lu}[\p{L}\p{M}]++(?:(?!['’]s(?![\p{L}\p{M}]))['’-][\p{L}\p{M}]++)*+"
         r"|\p{Lu}['’-][\p{L}\p{M}]++(?:['’-][\p{L}\p{M}]++)*+|\p{Lu}\.(?= [\p{L}])|\p{Lu}(?![\p{L}\p{M}]))")
_NEXT = rf"(?:(?:{_PARTICLES}) ){{0,4}}(?!(?:{_TITLES})\.? (?:(?:{_PARTICLES}) ){{0,4}}\p{{Lu}}){_PART}"
NAME = rf"(?<![\p{{L}}])(?:(?:{_TITLES})\.? ){{1,4}}{_NEXT}(?: {_NEXT})*+"
# First letters are looked at before the alternatives: most places of a text begin none of them.
_FIRST = "".join(sorted({t[0] for t in MALE + FEMALE + NEUTRAL}))
ANY = rf"{EMAIL}|(?=[aApPsStT]){SECRET}|{ACCESS}|(?=[+(\d])(?:{'|'.join((SSN, PHONE, CARD, IP, LOCAL))})|(?=[{_FIRST}]){NAME}"
_TITLED = rf"^(?:(?:{_TITLES})\.? ){{1,4}}"


def _unit(kind, unit) -> Column:
    return F.struct((kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"), unit.alias("unit"))


def _let(x: Column, f) -> Column:
    """f(x) with x evaluated once, not again for every element in f's own lambdas."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _phone(m: Column) -> Column:
    """The digits, after a + where the number has a country code."""
    return (F.when(F.startswith(m, F.lit("+")), F.concat(F.lit("+"), _digits(m)))
            .when(F.startswith(m, F.lit("00")), F.concat(F.lit("+"), F.substr(_digits(m), F.lit(3)))).otherwise(_digits(m)))


def _title_gender(m: Column) -> Column:
    titles = F.transform(F.split(F.rtrim(F.regexp_extract(m, _TITLED, 0)), " "), lambda x: F.rtrim(x, F.lit(".")))
    has = lambda known: F.exists(titles, lambda x: x.isin(*known))
    return F.when(has(MALE), "m").when(has(FEMALE), "f").otherwise("n")


def _secret_value(m: Column) -> Column:
    return F.regexp_extract(m, rf"^(?i:{_SECRET_WORD})[\"']?[ \t]*[=:][ \t]*[\"']?(.*)$", 1)


def _name_pieces(m: Column) -> Column:
    """The parts of a titled name with the particles before them."""
    return F.split(F.regexp_replace(m, _TITLED, ""), rf"(?<!(?:^| )(?:{_PARTICLES})) ")


def _particles(piece: Column) -> Column:
    return F.regexp_extract(piece, rf"^(?:(?:{_PARTICLES}) )*", 0)


def _mention(m: Column) -> Column:
    """The parts of a titled name, in order: the last is the surname, the ones before it are given names."""
    pieces = F.transform(_name_pieces(m), lambda x: F.substr(x, F.length(_particles(x)) + 1))
    return _let(F.struct(pieces.alias("p"), _title_gender(m).alias("g")), lambda a: F.transform(a["p"], lambda x, i: F.struct(
        x.alias("form"), F.lower(x).alias("word"), a["g"].alias("gender"), F.lower(F.element_at(a["p"], -1)).alias("last"),
        F.when(F.size(a["p"]) == 1, "single").when(i == F.size(a["p"]) - 1, "last").otherwise("given").alias("role"))))


def _name_unit(part: Column, known: Column) -> Column:
    """The unit of a part among all parts ``known`` in the document.

    A single word is a given name if it is one elsewhere and a surname nowhere.  The gender is the title's, or else the
    only one known for the word, or else the only one known for the surname."""
    role = lambda r: F.exists(known, lambda k: (k["word"] == part["word"]) & (k["role"] == r))
    given = (part["role"] == "given") | ((part["role"] == "single") & role("given") & ~role("last"))
    only = lambda same: F.array_distinct(F.transform(F.filter(known, lambda k: same(k) & (k["gender"] != "n")), lambda k: k["gender"]))
    own, house = only(lambda k: k["word"] == part["word"]), only(lambda k: k["last"] == part["last"])
    g = (F.when(part["gender"] != "n", part["gender"]).when(F.size(own) == 1, F.get(own, F.lit(0)))
         .when((F.size(own) == 0) & (F.size(house) == 1), F.get(house, F.lit(0))).otherwise("n"))
    script = F.when(F.rlike(part["word"], F.lit(r"[Ѐ-ӿ]")), "cyrillic").otherwise("latin")
    return _unit(F.when(given, F.concat(F.lit("given-"), script, F.lit("-"), g)).otherwise(
        F.concat(F.lit("surname-"), script, F.when(script == "cyrillic", F.concat(F.lit("-"), g)).otherwise(""))), part["word"])


def _repeats(known: Column) -> Column:
    """ANY, or one of the known names without a title (longer ones first; single letters would be in any text)."""
    forms = F.filter(F.transform(known, lambda k: k["form"]), lambda x: F.rlike(x, F.lit(r"\p{L}[^.]*\p{L}")))
    forms = F.array_distinct(F.concat(forms, F.transform(forms, lambda x: F.upper(x))))
    forms = F.transform(F.reverse(F.array_sort(F.transform(forms, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))), lambda x: x["x"])
    return F.when(F.size(forms) > 0, F.concat(F.lit(ANY + r"|(?<![\p{L}\p{M}])(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}\p{M}])"))).otherwise(F.lit(ANY))


def units_of(m: Column, known: Column) -> Column:
    """The units of one match, in order (one for each part of a name); ``known`` are the parts of the document's names."""
    full = lambda p: F.rlike(m, F.lit(f"^(?:{p})$"))
    same = F.filter(known, lambda k: (k["form"] == m) | (F.upper(k["form"]) == m))
    return (F.when(F.rlike(m, F.lit(_TITLED)), F.transform(_mention(m), lambda x: _name_unit(x, known)))
            .when(F.size(same) > 0, F.array(_name_unit(F.get(same, F.lit(0)), known)))
            .when(full(EMAIL), F.array(_unit("email", F.lower(m))))
            .when(full(SECRET), F.array(_unit("secret", _secret_value(m))))
            .when(full(ACCESS), F.array(_unit("access", m)))
            .when(full(SSN), F.array(_unit("ssn", _digits(m))))
            .when(full(PHONE), F.array(_unit("phone", _phone(m))))
            .when(full(CARD), F.array(_unit("card", _digits(m))))
            .when(full(IP), F.array(_unit("ip", m)))
            .otherwise(F.array(_unit("phone", _phone(m)))))


def _byte(stream: Column, i: Column) -> Column:
    """Pseudo-random number 0..65535 at place i (from 0) of a hex stream; it starts over after 63 places."""
    return F.conv(F.substr(stream, (F.pmod(i, F.lit(63)) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), (F.pmod(n, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def _chars(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


def _same_shape(x: Column, stream: Column, lower: str = "abcdefghijklmnopqrstuvwxyz",
                upper: str = "ABCDEFGHIJKLMNOPQRSTUVWXYZ") -> Column:
    return F.array_join(F.transform(_chars(x), lambda c, i: F.when(F.rlike(c, F.lit("[0-9]")), _pick("0123456789", _byte(stream, i)))
                                    .when(F.rlike(c, F.lit("[a-z]")), _pick(lower, _byte(stream, i)))
                                    .when(F.rlike(c, F.lit("[A-Z]")), _pick(upper, _byte(stream, i)))
                                    .when(F.rlike(c, F.lit("[а-я]")), _pick("абвгдежзиклмнопрстуфхцчшэюя", _byte(stream, i)))
                                    .when(F.rlike(c, F.lit(r"\p{Lu}")), _pick(upper, _byte(stream, i)))
                                    .when(F.rlike(c, F.lit(r"[\p{L}\p{N}]")), _pick(lower, _byte(stream, i)))
                                    .otherwise(c)), "")


def _luhn(x: Column) -> Column:
    """x with a valid check digit appended."""
    total = F.aggregate(F.transform(F.reverse(_chars(x)), lambda c, i: F.when(
        i % 2 == 0, F.floor(c.cast("int") * 2 / 10) + (c.cast("int") * 2) % 10).otherwise(c.cast("int")).cast("long")),
        F.lit(0).cast("long"), lambda a, d: a + d)
    return F.concat(x, ((10 - total % 10) % 10).cast("string"))


def _syllables(stream: Column, n: Column, first: str, second: str) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(
        _pick(first, _byte(stream, i * 2 + 1)), _pick(second, _byte(stream, i * 2 + 2)))), "")


def surrogate(kind: Column, unit: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a unit at the given attempt."""
    # The stream is bound once a row: inside the functions on single characters it would be hashed for each of them.
    seed = F.concat_ws("|", F.lit(key), kind, unit, attempt.cast("string"))
    stream = F.concat(*(F.sha2(F.concat(seed, F.lit(f"|{i}")).cast("binary"), 256) for i in range(4)))
    return _let(stream, lambda x: _drawn(kind, unit, attempt, x))


def _drawn(kind: Column, unit: Column, attempt: Column, stream: Column) -> Column:
    number = _same_shape(unit, stream)
    n = F.length(unit)
    local, domain = F.substring_index(unit, "@", 1), F.regexp_extract(unit, "@([^.]*)", 1)
    email = F.concat(_same_shape(local, stream), F.lit("@"), _same_shape(domain, F.reverse(stream)),
                     F.when(attempt > 2, attempt.cast("string")).otherwise(""), F.lit(".example.com"))
    # Phones keep the country code and a trunk 0 or 1; the next digit is not 0 or 1.
    lead = F.regexp_extract(unit, rf"^(?:\+{_COUNTRY}0?|0|1(?=\d{{10}}$))?", 0)
    phone = F.concat(lead, _pick("23456789", _byte(stream, F.lit(60))), F.substr(number, F.length(lead) + 2, n))
    card = _luhn(F.concat(F.substr(unit, F.lit(1), F.lit(1)), F.substr(number, F.lit(2), n - 2)))
    # 10/8 holds 16 million addresses; whoever still collides goes to the reserved 240/4.
    ip = F.concat_ws(".", F.when(attempt > 3, (_byte(stream, F.lit(3)) % 15 + 240).cast("string")).otherwise("10"),
                     *((_byte(stream, F.lit(j)) % 256).cast("string") for j in range(2)),
                     (_byte(stream, F.lit(2)) % 254 + 1).cast("string"))
    ssn = F.concat(F.lit("9"), F.substr(number, F.lit(2), F.lit(8)))
    access = F.concat(F.substr(unit, F.lit(1), F.lit(4)), _same_shape(F.substr(unit, F.lit(5), n - 4), stream))
    # A secret without letters or digits (a mask of asterisks), or of few free places, grows until it is distinct.
    longer = F.substr(stream, F.lit(1), F.least(F.greatest(attempt - 2, F.lit(0)), F.lit(32)))
    secret = F.concat(F.when(F.rlike(unit, F.lit("^[0-9a-f]+$")), _same_shape(unit, stream, "abcdef")).otherwise(number), longer)
    more = F.least(attempt, F.lit(20)) + 2
    latin, cyrillic = _syllables(stream, more, "bdfgklmnprstvz", "aeiou"), _syllables(stream, more, "бвгдзклмнпрст", "аеиоу")
    end = lambda *pairs: reduce(lambda c, p: c.when(F.endswith(kind, F.lit(p[0])), p[1]), pairs, F.when(F.lit(False), ""))
    name = F.initcap(
        F.when(kind.startswith("given-latin"), F.concat(latin, end(("-f", "na"), ("-m", "ron"), ("-n", "ris"))))
        .when(kind.startswith("given-cyrillic"), F.concat(cyrillic, end(("-f", "на"), ("-m", "мир"), ("-n", "ша"))))
        .when(kind.startswith("surname-cyrillic"), F.concat(cyrillic, end(("-f", "нова"), ("-m", "нов"), ("-n", "ненко"))))
        .otherwise(F.concat(latin, _pick("nrslt", _byte(stream, F.lit(0))))))
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ip", ip)
            .when(kind == "ssn", ssn).when(kind == "access", access).when(kind == "secret", secret).otherwise(name))


def assign(units: DataFrame, key: str = KEY) -> DataFrame:
    """Rows (kind, unit, surrogate), one for each distinct unit, without collisions."""
    units = cut(units.select("kind", "unit").distinct())
    now = units.withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(F.col("kind"), F.col("unit"), F.lit(0), key))
    for _ in range(ROUNDS):
        now = cut(now)
        real = units.select(F.col("kind").alias("k2"), F.col("unit").alias("u2"))
        best = (now.groupBy(F.col("kind").alias("k1"), F.lower("surrogate").alias("low"))
                .agg(F.min(F.struct("attempt", "unit")).alias("first"), F.count("*").alias("c")).where("c > 1"))
        bad = (now.join(best, (F.col("kind") == F.col("k1")) & (F.lower("surrogate") == F.col("low")))
               .where(F.struct("attempt", "unit") > F.col("first")).select("kind", "unit"))
        # A surrogate that is a real unit would point at somebody else.
        for form in (F.col("surrogate"), F.lower("surrogate")):
            bad = bad.unionByName(now.join(real, (F.col("kind") == F.col("k2")) & (form == F.col("u2"))).select("kind", "unit"))
        bad = cut(bad.distinct())
        if bad.isEmpty():
            return now.select("kind", "unit", "surrogate")
        again = now.join(bad.withColumn("again", F.lit(1)), ["kind", "unit"], "left")
        attempt = F.col("attempt") + F.coalesce("again", F.lit(0))
        now = again.select("kind", "unit", attempt.alias("attempt"), F.when(
            F.col("again").isNotNull(), surrogate(F.col("kind"), F.col("unit"), attempt, key)).otherwise(F.col("surrogate")).alias("surrogate"))
    raise ValueError("a type has more distinct entities than distinct surrogates")


def _fill(m: Column, digits: Column) -> Column:
    """m with its digits replaced, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))
    return F.aggregate(_chars(m), start, lambda a, c: F.when(F.rlike(c, F.lit("[0-9]")), F.struct(
        F.concat(a["out"], F.substr(digits, a["i"], F.lit(1))).alias("out"), (a["i"] + 1).alias("i"))).otherwise(
        F.struct(F.concat(a["out"], c).alias("out"), a["i"].alias("i"))), lambda a: a["out"])


def _replacement(m: Column, units: Column, found: Column) -> Column:
    """What stands for match m with these units, given the map (kind, unit) -> surrogate."""
    one = F.element_at(units, 1)
    kind, s = one["kind"], F.element_at(found, one)
    title = F.regexp_extract(m, _TITLED, 0)
    name = F.transform(F.arrays_zip(_name_pieces(m).alias("p"), units.alias("u")), lambda z: F.concat(_particles(z["p"]), F.element_at(found, z["u"])))
    return (F.when(kind == "phone", _fill(m, F.concat(F.when(F.startswith(m, F.lit("00")), "00").otherwise(""), _digits(s))))
            .when(kind.isin("card", "ssn"), _fill(m, s))
            .when(kind.isin("email", "ip", "access"), s)
            .when(kind == "secret", F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(one["unit"])), s))
            .otherwise(F.concat(title, F.array_join(name, " "))))


def pseudonymize(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with entities replaced in ``text``, and n_entities and entity_types."""
    docs = docs.drop("n_entities", "entity_types")
    t = F.col(text)
    columns = docs.columns
    hit = F.coalesce(F.rlike(t, F.lit(ANY)), F.lit(False))
    none = docs.where(~hit).withColumns({"n_entities": F.lit(0), "entity_types": F.expr("cast(array() as array<string>)")})
    rows = docs.where(hit).withColumn("__key", F.xxhash64(*columns[:1], text)).withColumn("__m", F.regexp_extract_all(t, F.lit(ANY), 0))
    titled = F.filter("__m", lambda m: F.rlike(m, F.lit(_TITLED)))
    rows = rows.withColumn("__k", F.array_distinct(F.flatten(F.transform(titled, _mention)))).withColumn("__p", _repeats(F.col("__k")))
    # Only documents with names are searched again, for these names without a title.
    rows = rows.withColumn("__m", F.when(F.size("__k") > 0, F.regexp_extract_all(t, F.col("__p"), 0)).otherwise(F.col("__m")))
    rows = rows.withColumn("__u", F.transform("__m", lambda m: units_of(m, F.col("__k"))))
    flat = rows.select("__key", F.explode(F.array_distinct(F.flatten("__u"))).alias("u")).select("__key", "u.kind", "u.unit")
    flat = cut(flat.distinct())
    table = assign(flat, key)
    maps = (flat.join(table, ["kind", "unit"]).groupBy("__key")
            .agg(F.map_from_entries(F.collect_list(F.struct(F.struct("kind", "unit"), "surrogate"))).alias("__map")))
    parts = F.when(F.size("__k") > 0, F.split(t, F.col("__p"), -1)).otherwise(F.split(t, ANY, -1))
    new = F.transform(F.arrays_zip("__m", "__u"), lambda z: _replacement(z["__m"], z["__u"], F.col("__map")))
    body = F.array_join(F.concat(F.array(F.element_at(parts, 1)), F.transform(new, lambda r, i: F.concat(r, F.element_at(parts, i + 2)))), "")
    done = (rows.join(maps, "__key").withColumns({
        "n_entities": F.size("__m"), "entity_types": F.array_sort(F.array_distinct(F.transform(F.flatten("__u"), lambda u: F.substring_index(u["kind"], "-", 1)))),
        text: body}))
    return none.unionByName(done.select(*none.columns))
