"""Personal data and secrets: find them and put keyed surrogates of the same form in their place.

Built-in column functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recprep.llm.common import free_name
from recprep.session import materialize

# Titles before names by gender, alphabets by script, and patterns (Java syntax).
MALE_TITLES = ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Signor", "господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Signora", "госпожа"]
LATIN = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"
GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
HAN = "王李张刘陈杨黄赵吴周徐孙马朱胡林郭何高罗"
ARABIC = "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"
HEBREW = "אבגדהוזחטיכלמנסעפצקרשת"
HANGUL = "가나다라마바사아자차카타파하거너더러머버"
HIRAGANA = "あいうえおかきくけこさしすせそたちつてと"
KATAKANA = "アイウエオカキクケコサシスセソタチツテト"
DEVANAGARI = "अआइईउकखगघचछजझटठडढतथदधनपफबभमयरलवसह"
THAI = "กขคงจชซญดตถทนบปผพมยรลวสหอ"
SCRIPTS = {
    "Cyrillic": CYRILLIC, "Greek": GREEK, "Han": HAN, "Arabic": ARABIC, "Hebrew": HEBREW, "Hangul": HANGUL,
    "Hiragana": HIRAGANA, "Katakana": KATAKANA, "Devanagari": DEVANAGARI, "Thai": THAI,
}
BIRTH_WORDS = [
    "born", "born on", "date of birth", "birth date", "birthday", "dob", "geboren am", "geburtsdatum", "né le", "née le",
    "date de naissance", "nació el", "fecha de nacimiento",
]
CONSONANTS = {"latin": "bdfgklmnprstv", "cyrillic": "бвгдзклмнпрст"}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу"}
MALE_ENDS = {"latin": "nrslk", "cyrillic": "нрлкм"}
FEMALE_ENDS = {"latin": "a", "cyrillic": "а"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_HEX = "[0-9A-Fa-f]{1,4}"
_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./-]\d{1,2}[./-]\d{4})(?![\d./-]*\d)"
PATTERNS = {
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=(?i:password|passwd|pwd|secret|token|api_key|api-key|apikey)\s{0,3}[=:]\s{0,3}[\"']{0,1})"
              r"(?=[A-Za-z_+/=-]{0,80}\d)[A-Za-z0-9_+/=-]{8,}",
    "email": r"[\p{L}\p{M}\p{N}._%+-]+@[\p{L}\p{M}\p{N}-]+(?:\.[\p{L}\p{M}\p{N}-]+)+",
    # Written with a first group of three or four digits, as addresses of hosts are.
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f]{{3,4}}:)(?:(?:{_HEX}:){{7}}{_HEX}"
            rf"|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}:])",
    "birth": rf"(?<=(?i:{'|'.join(BIRTH_WORDS)})[: ]{{1,3}}){_DATE}",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
             r"|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\d-])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? {_NAME}(?: {_NAME})?",
}
# One pattern for all kinds. Each branch starts with a check of one character, so a position
# inside a word costs next to nothing; the checks are implied by the branch and change no match.
# An e-mail address starts where its run of characters starts, or where a match has just ended.
_RUN = r"[\p{L}\p{M}\p{N}._%+-]"
_NUMBERS = "|".join(f"(?:{PATTERNS[k]})" for k in ("ip", "phone", "ssn", "card"))
ANY = "|".join([
    f"(?=A){PATTERNS['access_key']}",
    r"(?<=[=:\s\"'])(?<=[=:]\s{0,3}[\"']{0,1})" + PATTERNS["secret"],
    rf"(?:(?<!{_RUN})|\G){PATTERNS['email'].replace('+@', '++@')}",
    f"(?=[0-9A-Fa-f]){PATTERNS['ipv6']}",
    f"(?=[0-9])(?<=[: ]){PATTERNS['birth']}",
    f"(?=[0-9+(])(?:{_NUMBERS})",
    f"(?=[A-Z]){PATTERNS['iban']}",
    f"(?=[{''.join(sorted({t[0] for t in MALE_TITLES + FEMALE_TITLES}))}]){PATTERNS['name']}",
]).replace(r"([ -])", "(?<gap>[ -])").replace(r"\1", r"\k<gap>")
# No entity without one of these.
HINT = rf"[0-9@]|(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? \p{{Lu}}"
DIGIT_KINDS = ["phone", "ssn", "card"]
KEY_SETTING = "spark.recprep.pii.key"


def pii_key(spark: SparkSession) -> str:
    """The secret key of the surrogates; without the setting, a published one that protects nobody."""
    return spark.conf.get(KEY_SETTING, None) or "recprep-example-key"


def _full(value: Column, kind: str) -> Column:
    return value.rlike(f"^(?:{PATTERNS[kind]})$")


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum; every second digit counts twice, from the last one on or from the one before it."""
    last = F.length(digits)
    turn = 1 if double_last else 0

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, last - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(F.pmod(i, F.lit(2)) == turn, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), last), F.lit(0), add)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def kind_of(value: Column) -> Column:
    """Kind of a match; null for digit runs that are no card number (Luhn)."""
    return (
        F.when(value.contains("@"), "email")
        .when(_full(value, "access_key"), "access_key")
        .when(_full(value, "ip"), "ip")
        .when(_full(value, "ipv6"), "ipv6")
        .when(value.rlike(f"^{_DATE}$"), "birth")
        .when(_full(value, "phone"), "phone")
        .when(_full(value, "ssn"), "ssn")
        .when(_full(value, "card") & value.rlike(r"^[0-9 -]+$"), F.when(F.pmod(_luhn_sum(digits_of(value), False), F.lit(10)) == 0, "card"))
        .when(_full(value, "name"), "name")
        .when(_full(value, "iban"), "iban")
        .otherwise("secret")
    )


def canonical(value: Column, kind: Column) -> Column:
    """What two mentions of one entity have in common: the digits, the name without title, lower case."""
    return (
        F.when(kind.isin(DIGIT_KINDS), digits_of(value))
        .when(kind == "name", F.lower(F.regexp_replace(value, r"^\S+ ", "")))
        .when(kind.isin("email", "ipv6"), F.lower(value))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .otherwise(value)
    )


def _stream(key: str, kind: Column, what: Column, attempt: Column) -> Column:
    """128 hex digits that depend on the key, the kind, the entity and the attempt (nested keyed hash)."""
    message = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), what)
    return F.sha2(F.concat(F.lit(key + "|"), F.sha2(message, 256)), 512)


def _byte(stream: Column, i: Column) -> Column:
    at = F.pmod(i * 2, F.lit(128)) + 1
    return F.conv(F.substring(stream, at, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(number, F.lit(len(alphabet))) + 1, F.lit(1))


def _other(alphabet: str, c: Column, number: Column) -> Column:
    """A letter of the alphabet that is not ``c``."""
    at = F.call_function("instr", F.lit(alphabet), c)  # from 1; 0 for a letter outside
    return F.substring(F.lit(alphabet), F.pmod(at + F.pmod(number, F.lit(len(alphabet) - 1)), F.lit(len(alphabet))) + 1, F.lit(1))


def _same_form(value: Column, stream: Column, keep: Column, hexed: Column) -> Column:
    """Replace letters and digits one by one, each letter by another one of its script and case (of
    the Latin alphabet, for a script that has none here); keep the rest.

    ``keep``: so many letters and digits at the start stay. ``hexed``: letters stay in a-f.
    """

    def letter(c: Column, n: Column) -> Column:
        low, upper = F.lower(c), c.rlike(r"\p{Lu}")
        new = F.when(low.rlike("[a-z]"), F.when(hexed, _other("abcdef", low, n)).otherwise(_other(LATIN, low, n)))
        for script, alphabet in SCRIPTS.items():
            new = new.when(low.rlike(rf"\p{{Is{script}}}"), _other(alphabet, low, n))
        new = new.otherwise(_other(LATIN, low, n))
        return F.when(upper, F.upper(new)).otherwise(new)

    def step(acc: Column, c: Column) -> Column:
        k, n = acc["k"], _byte(stream, acc["k"])
        inside, mark = c.rlike(r"[\p{L}\p{Nd}]"), c.rlike(r"\p{M}")
        new = F.when(c.rlike(r"\p{Nd}"), F.pmod(n, F.lit(10)).cast("string")).otherwise(letter(c, n))
        # A mark belongs to the letter that went.
        shown = F.when(inside & (k >= keep), new).when(mark & (k > keep), F.lit("")).otherwise(c)
        return F.struct(F.concat(acc["out"], shown).alias("out"), (k + inside.cast("int")).alias("k"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
    return F.aggregate(F.split(value, ""), start, step, lambda acc: acc["out"])


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _more(stream: Column, attempt: Column) -> Column:
    """Letters that a later attempt adds where the form leaves too few surrogates (short names)."""
    return F.translate(F.substring(stream, F.lit(97), attempt * 2), "0123456789", "ghjklmnpqr")


def _spoken(word: Column, stream: Column, gender: Column) -> Column:
    """A word of syllables in the script of ``word``, ending as names of the gender do."""

    def build(script: str) -> Column:
        syllables = F.transform(
            F.sequence(F.lit(0), F.pmod(_byte(stream, F.lit(60)), F.lit(2)) + 1),
            lambda i: F.concat(_pick(CONSONANTS[script], _byte(stream, i * 2)), _pick(VOWELS[script], _byte(stream, i * 2 + 1))),
        )
        end = (
            F.when(gender == "f", F.concat(_pick(CONSONANTS[script], _byte(stream, F.lit(40))), _pick(FEMALE_ENDS[script], _byte(stream, F.lit(41)))))
            .when(gender == "m", _pick(MALE_ENDS[script], _byte(stream, F.lit(42))))
            .otherwise(_pick(CONSONANTS[script], _byte(stream, F.lit(43))))
        )
        return F.initcap(F.concat(F.array_join(syllables, ""), end))

    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), build("cyrillic")).when(word.rlike(r"\p{IsLatin}"), build("latin"))
        .otherwise(_same_form(word, stream, F.lit(0), F.lit(False)))
    )


def surrogate(value: Column, kind: Column, stream: Column, attempt: Column, key: str) -> Column:
    """The replacement for a mention; ``stream`` is its :func:`_stream` of the same attempt.

    It has the kind, script, case, length and punctuation of the mention. Dates of birth stay dates, within
    ten years of the mention, and days and months that could be read either way fit both. Card numbers pass the
    Luhn test and keep the first digit, telephone numbers keep the first digit of the country,
    e-mail addresses keep the top-level domain, and equal domains stay equal. Names keep the
    title; each word of a name has one replacement per gender, so a surname is the same in all
    its mentions. It depends on the canonical entity and the key alone: equal in all documents.
    """
    digits = digits_of(value)
    plain = F.lit(False)

    body = _same_form(F.substring(digits, F.lit(1), F.length(digits) - 1), stream, F.lit(1), plain)
    number = _once(body, lambda b: F.concat(b, F.pmod(F.lit(10) - F.pmod(_luhn_sum(b, True), F.lit(10)), F.lit(10)).cast("string")))
    spread = _once(number, lambda n: F.aggregate(
        F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")),
        lambda acc, c: F.struct(
            F.concat(acc["out"], F.when(c.rlike("[0-9]"), F.substring(n, acc["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (acc["k"] + c.rlike("[0-9]").cast("int")).alias("k"),
        ),
        lambda acc: acc["out"],
    ))

    octets = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda i: (F.pmod(_byte(stream, i * 2) * 256 + _byte(stream, i * 2 + 1), F.lit(222)) + 1).cast("string"),
    )

    parts = F.split(value, "[./-]")
    year_first = F.length(parts[0]) == 4
    date = F.replace(F.array_join(F.transform(parts, lambda p, i: _once(_byte(stream, i), lambda n: F.lpad(
        F.when(F.length(p) == 4, F.greatest(p.cast("int") - 10 + F.pmod(n, F.lit(21)), F.lit(1000)))
        .when(F.length(p) == 1, F.pmod(n, F.lit(9)) + 1)
        .when(year_first & (i == 2), F.pmod(n, F.lit(28)) + 1)
        .otherwise(F.pmod(n, F.lit(12)) + 1).cast("string"),
        F.length(p), F.lit("0"),
    ))), "|"), F.lit("|"), F.regexp_extract(value, "[./-]", 0))

    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    host_stream = _stream(key, F.lit("host"), F.lower(domain), F.lit(0))
    address = F.concat(
        _same_form(local, stream, F.lit(0), plain), _more(stream, attempt), F.lit("@"),
        _same_form(host, host_stream, F.lit(0), plain), F.lit("."), top,
    )

    title = F.regexp_extract(value, r"^(\S+) ", 1)
    bare = F.regexp_replace(title, r"\.$", "")
    gender = F.when(bare.isin(MALE_TITLES), "m").otherwise("f")
    words = F.split(F.regexp_replace(value, r"^\S+ ", ""), " ")
    spoken = F.transform(words, lambda w, i: _spoken(
        w, _stream(key, F.lit("word"), F.lower(w), attempt), F.when(i < F.size(words) - 1, gender).otherwise(F.lit("s"))
    ))
    person = F.concat(title, F.lit(" "), F.array_join(spoken, " "), _more(stream, attempt))

    hexed = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    return (
        F.when(kind == "card", spread).when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "email", address).when(kind == "name", person).when(kind == "birth", date)
        .when(kind == "ipv6", _same_form(value, stream, F.lit(0), F.lit(True)))
        .when(kind == "phone", _same_form(value, stream, value.startswith("+").cast("int"), plain))
        .when(kind == "access_key", _same_form(value, stream, F.lit(4), plain))
        .when(kind == "iban", _same_form(value, stream, F.lit(2), plain))
        .otherwise(_same_form(value, stream, F.lit(0), hexed))
    )


def _matches(text: Column) -> Column:
    """All matches in a text as (value, kind, what), in order. Each step names its fields once, so
    that later steps refer to them and don't repeat the expressions."""
    found = F.regexp_extract_all(text, F.lit(ANY), 0)
    kinds = F.transform(found, lambda m: F.struct(m.alias("value"), kind_of(m).alias("kind")))
    return F.transform(kinds, lambda m: F.struct(
        m["value"].alias("value"), m["kind"].alias("kind"), canonical(m["value"], m["kind"]).alias("what")
    ))


def mentions(text: Column) -> Column:
    """Array of (value, kind, what) of the entities in a text, in order; empty for null."""
    none = F.array().cast("array<struct<value:string,kind:string,what:string>>")
    return F.when(text.rlike(HINT), F.filter(_matches(text), lambda m: m["kind"].isNotNull())).otherwise(none)


def retries(entities: DataFrame, key: str, rounds: int = 20) -> DataFrame:
    """Attempt numbers of entities whose first surrogate collides: kind, what, attempt (1 or more).

    entities: distinct (kind, what, value). A surrogate collides if a smaller entity of its kind
    has the same one, or if it is itself an entity of the text. Checked over all entities
    until no collision is left; usually none is there to begin with.
    """
    state = entities.withColumn("attempt", F.lit(0))
    real = entities.select(F.col("kind").alias("real_kind"), F.col("what").alias("real_what"))
    for _ in range(rounds):
        kind = F.col("kind")
        streams = materialize(state.withColumn("stream", _stream(key, kind, F.col("what"), F.col("attempt"))))
        new = streams.withColumn("new", surrogate(F.col("value"), kind, F.col("stream"), F.col("attempt"), key))
        made = materialize(new.drop("stream")).withColumn("made", canonical(F.col("new"), kind)).drop("new")
        same = F.row_number().over(Window.partitionBy("kind", "made").orderBy("what")) > 1
        clash = materialize(
            made.withColumn("same", same)
            .join(real, (F.col("kind") == F.col("real_kind")) & (F.col("made") == F.col("real_what")), "left")
            .filter(F.col("same") | F.col("real_what").isNotNull()).select("kind", "what", F.lit(1).alias("again"))
        )
        if clash.isEmpty():
            return state.filter("attempt > 0").select("kind", "what", "attempt")
        state = materialize(
            state.join(clash, ["kind", "what"], "left")
            .withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0))).drop("again")
        )
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def replace(
    df: DataFrame, *, key: str | None = None, text_col: str = "text", found_col: str = "pii_found",
) -> DataFrame:
    """The table with surrogates in its text, and the kinds of what was replaced in ``found_col`` (array).

    Distinct entities of a kind get distinct surrogates, none of which is a real entity of the
    table; equal entities get equal ones.

    Defined cases: null text stays null and has no kinds; text without entities is unchanged;
    repeated rows are changed alike; an empty table stays empty. Other columns stay as they
    are, whatever their names; a column named ``found_col`` is replaced.
    """
    key = key or pii_key(df.sparkSession)
    text = F.col(f"`{text_col}`")
    entities = materialize(
        df.select(F.explode(mentions(text)).alias("m")).groupBy("m.kind", "m.what").agg(F.min("m.value").alias("value"))
    )
    again = materialize(retries(entities, key))
    if again.isEmpty():
        return _rewrite(df, text_col, found_col, key, lambda kind, what: F.lit(0))
    # Documents with such entities are few; the map of each is found by the digest of its text.
    digest = F.sha2(text, 256)
    told, attempts = free_name(df, "of_text"), free_name(df, "pii_attempts")
    maps = (
        df.select(digest.alias(told), F.explode(mentions(text)).alias("m")).select(told, "m.kind", "m.what")
        .distinct().join(again, ["kind", "what"]).groupBy(told)
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "what"), "attempt"))).alias(attempts))
    )
    joined = df.join(maps, digest == F.col(told), "left").drop(told)
    known = F.col(attempts)
    out = _rewrite(
        joined, text_col, found_col, key,
        lambda kind, what: F.coalesce(F.try_element_at(known, F.concat_ws("|", kind, what)), F.lit(0)),
    )
    return out.drop(attempts)


def _rewrite(df: DataFrame, text_col: str, found_col: str, key: str, attempt_of) -> DataFrame:
    text = F.col(f"`{text_col}`")
    told = F.transform(_matches(text), lambda m: F.struct(
        m["value"].alias("value"), m["kind"].alias("kind"), m["what"].alias("what"),
        attempt_of(m["kind"], m["what"]).alias("attempt"),
    ))
    keyed = F.transform(told, lambda m: F.struct(
        m["value"].alias("value"), m["kind"].alias("kind"), m["attempt"].alias("attempt"),
        _stream(key, m["kind"], m["what"], m["attempt"]).alias("stream"),
    ))
    new = F.transform(keyed, lambda m: F.struct(
        m["kind"].alias("kind"),
        F.when(m["kind"].isNull(), m["value"]).otherwise(
            surrogate(m["value"], m["kind"], m["stream"], m["attempt"], key)
        ).alias("value"),
    ))
    none = F.array().cast("array<struct<kind:string,value:string>>")
    rest = [c for c in df.columns if c != found_col]
    marked = df.select(*[F.col(f"`{c}`") for c in rest], F.when(text.rlike(HINT), new).otherwise(none).alias(found_col))
    hits = F.col(f"`{found_col}`")
    joined = F.array_join(
        F.zip_with(F.split(text, ANY), hits, lambda g, m: F.concat(g, F.coalesce(m["value"], F.lit("")))), ""
    )
    changed = F.when(F.size(hits) > 0, joined).otherwise(text).alias(text_col)
    kinds = F.array_compact(F.transform(hits, lambda m: m["kind"])).alias(found_col)
    return marked.select(*[F.col(f"`{c}`") if c != text_col else changed for c in rest], kinds)
