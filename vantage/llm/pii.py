"""Personal data replaced by keyed surrogates.

Detected entities (e-mail addresses, phone and card numbers, IP addresses of
both versions, IBANs, secret keys in hexadecimal or with a provider's prefix,
titled names of up to three parts) get replacements that keep type, length,
script and format: every character is shifted inside its class (digit, vowel
or consonant of its script) by a keyed hash of the whole entity, so a surrogate
looks like its original, a valid card number stays valid, octets stay octets,
first names keep the ending that carries their gender, and text in any layout
("+1 (222) 555-0000", "222-555-0000") of one number becomes the same new
number in that layout, country code and leading zeros kept. One entity has one surrogate in the whole corpus
(coreference); parts that entities share are keyed on their own: the domain of
addresses, family names, first names by gender. Where a document names a person
with a title, the parts of that name are replaced at all their places in the
document, titled or not ("Mr John Smith came. Smith said that John was late.").

Distinctness is checked over the corpus: two entities of a kind must not share
a surrogate, and no surrogate may equal an entity that occurs. Losers are
hashed again with the next counter until none is left; entities that are not
involved keep their surrogate. Where a shape is (nearly) full, losers after
``max_rounds`` get one character more a round behind their first, IP addresses
octets of any length; an entity still without a surrogate is an error. Letters
and digits outside the fixed classes move inside their script (the letters or
digits of their 16 code points; CJK and Hangul inside their whole range).

DataFrame operations only. Texts without an entity never leave their task.
Entities are counted before they are shuffled, and frequent ones are joined by
broadcast, at most 1,000 of them.

Defined results: a null text stays null, an empty one empty, without entities;
rows are taken one by one, so repeated rows and null or repeated ids give a row
each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.shared import join_split, written

# Titles and the gender they tell (fixed values).
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Sig", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof"),
}
# Character classes within which surrogates move (fixed values).
CLASSES = (
    "0123456789",
    "aeiouy",
    "bcdfghjklmnpqrstvwxz",
    "àáâãäåæèéêëìíîïòóôõöøùúûü",
    "çñšžß",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
)
HEX_CLASSES = ("0123456789", "abcdef")
# Ranges of code points that are letters throughout (fixed values).
RANGES = ((0x4E00, 0x9FFF), (0xAC00, 0xD7A3))
# Kinds that may grow, and rounds in which they do.
GROWING = ("email", "domain", "family", "given_m", "given_f", "given_n", "phone")
GROWTH_ROUNDS = 32

EDGE = r"[\p{L}\p{N}]"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_HEX = "[0-9a-fA-F]{1,4}"
# Prefixes of providers' keys, with what may follow (fixed formats).
_TOKENS = (
    r"(?:AKIA|ASIA)(?=[0-9A-Z]{16}(?![0-9A-Za-z]))",
    r"(?:sk|pk|rk)_(?:live|test)_(?=[0-9A-Za-z]{16})",
    r"gh[pousr]_(?=[0-9A-Za-z]{36})",
    r"github_pat_(?=[0-9A-Za-z_]{40})",
    r"glpat-(?=[0-9A-Za-z_-]{20})",
    r"xox[abposr]-(?=[0-9A-Za-z-]{10})",
    r"AIza(?=[0-9A-Za-z_-]{35})",
    r"sk-(?=[0-9A-Za-z]{20})",
)
TOKEN = "|".join(_TOKENS)
_TITLE = "|".join(t for group in TITLES.values() for t in group)
# National phone numbers, 9 to 12 digits: area code in brackets, three-three-four,
# a leading 0, or groups with hyphens. Not dates, not parts of longer numbers.
_BRACKETED = r"\((?=\d(?:[) .-]{0,2}\d){8,11})\d{2,5}\)[ .-]?(?:\d{3}[ .-]?\d{4}|(?:\d{2}[ .-]){3}\d{2}|\d{6,8}|\d{2,4}[ .-]\d{2,4}(?:[ .-]\d{2,4})?)"
_THREES = r"(?:1[ .-])?[2-9]\d{2}(?<sep>[ .-])[2-9]\d{2}\k<sep>\d{4}"
_ZERO = r"(?=0\d(?:[ /-]?\d){7,10}(?![ /-]?\d))0\d{1,4}(?:[ /-]\d{2,8}){1,4}"
_HYPHENS = r"(?=\d(?:-?\d){8,11}(?!-?\d))\d{2,4}(?:-\d{2,4}){2,4}"
_DATE = r"(?:(?:19|20)\d{2}[ ./-][01]\d[ ./-][0-3]\d|[0-3]\d[ ./-][0-3]\d[ ./-](?:19|20)\d{2})(?!\d)"
_NATIONAL = rf"(?<!\d[.,:/ -])(?!{_DATE})(?:{_BRACKETED}|{_THREES}|{_ZERO}|{_HYPHENS})(?![.,:/-]\d)(?! \d{{3}})"
# What a phone number keeps: country code, leading zeros, signs between.
_CODE = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
PREFIX = rf"^(?:\+ ?(?:{_CODE})[ .-]*\(?0*|\(?0+[ ./-]*|1[ .-]+|\()"
PATTERNS = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}._%+-]*+@[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+)+",
    "token": rf"(?<![\p{{L}}\p{{N}}_-])(?:{TOKEN})[0-9A-Za-z_-]+(?![\p{{L}}\p{{N}}_-])",
    "secret": rf"(?<!{EDGE})[0-9a-fA-F]{{32,64}}(?!{EDGE})",
    "iban": rf"(?<!{EDGE})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?!{EDGE})",
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?{EDGE})",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9a-fA-F:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?=(?:[0-9a-fA-F]*:){{2,7}}[0-9a-fA-F]*(?![0-9a-fA-F:]))(?:{_HEX}(?::{_HEX})*)?::(?:{_HEX}(?::{_HEX})*)?)(?![\p{{L}}\p{{N}}:]|\.\d)",
    "phone": rf"(?<!{EDGE})(?:(?:\+\d{{1,3}}[ .-]?)(?:\(\d{{2,4}}\)|\d{{2,4}})(?:[ .-]?\d{{2,4}}){{2,4}}|{_NATIONAL})(?!{EDGE})",
    "card": rf"(?<!{EDGE})\d(?:[ -]?\d){{12,18}}(?!{EDGE})",
    "name": rf"(?<!{EDGE})(?:{_TITLE})\.? {_NAME}(?: {_NAME}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Cheap test that every text with an entity passes.
MAYBE = rf"[0-9@]|{_TITLE}"
KINDS = tuple(PATTERNS)


@dataclass(frozen=True)
class SurrogateConfig:
    """``key`` makes the replacements unguessable; set your own."""

    key: str = "corpus-surrogates-1"
    max_rounds: int = 64


def placed(docs: DataFrame) -> DataFrame:
    try:
        return docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
            F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"),
        )
    except AnalysisException:
        return placed(written(docs.select("doc_id", "text"), "pii-input"))


def kind_of(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def _part(pre: Column, kind: Column, key: Column, form: Column) -> Column:
    return F.struct(pre.alias("pre"), kind.alias("kind"), key.alias("key"), form.alias("form"))


def parts_of(kind: Column, m: Column) -> Column:
    """A mention as parts: the text before each, its kind, key and form."""
    empty = F.lit("")
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    email = F.array(
        _part(empty, F.lit("email"), F.lower(m), local), _part(F.lit("@"), F.lit("domain"), F.lower(domain), domain)
    )
    bare = F.lower(F.regexp_replace(m, r"[^\p{L}\p{N}]", ""))
    prefix = F.regexp_extract(m, PREFIX, 0)
    rest = F.substring(m, F.length(prefix) + 1, F.length(m))
    phone = F.array(_part(prefix, F.lit("phone"), F.regexp_replace(rest, r"\D", ""), rest))
    words = F.split(m, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("n")
    def name_part(i: Column) -> Column:
        pre = F.when(i == 1, F.concat(words[0], F.lit(" "))).otherwise(F.lit(" "))
        first = (i == 1) & (F.size(words) > 2)
        return _part(pre, F.when(first, F.concat(F.lit("given_"), gender)).otherwise("family"), F.lower(F.get(words, i)), F.get(words, i))

    names = F.transform(F.sequence(F.lit(1), F.size(words) - 1), name_part)
    token = F.regexp_extract(m, f"^(?:{TOKEN})", 0)
    body = F.substring(m, F.length(token) + 1, F.length(m))
    return (
        F.when(kind == "email", email)
        .when(kind == "name", names)
        .when(kind == "token", F.array(_part(token, kind, F.lower(body), body)))
        .when(kind == "ipv6", F.array(_part(empty, kind, F.lower(m), m)))
        .when(kind == "phone", phone)
        .when(kind == "ip", F.array(_part(empty, kind, m, m)))
        .otherwise(F.array(_part(empty, kind, bare, m)))
    )


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")


def _shift_in_script(ch: Column, step: Column) -> Column:
    point = F.ascii(ch)
    begin = point - F.pmod(point, F.lit(16))
    near = F.transform(F.sequence(begin, begin + 15), _code_point)
    digits = F.filter(near, lambda x: x.rlike(r"^\p{N}$"))
    letters = F.filter(near, lambda x: x.rlike(r"^[\p{L}&&[^\p{Lu}\p{Lt}]]$"))
    pick = lambda cls: F.get(cls, F.pmod(F.array_position(cls, ch) - 1 + step, F.size(cls)).cast("int"))
    out = F.when(ch.rlike(r"^\p{N}$"), pick(digits)).when(ch.rlike(r"^\p{L}$") & F.array_contains(letters, ch), pick(letters))
    for low, high in RANGES:
        moved = _code_point(F.pmod(point - low + step, F.lit(high - low + 1)) + low)
        out = F.when(point.between(low, high), moved).otherwise(out)
    return F.coalesce(out, ch)


def _shift(ch: Column, step: Column, classes: tuple[str, ...]) -> Column:
    out = _shift_in_script(ch, step) if classes is CLASSES else ch
    for cls in classes:
        at = F.instr(F.lit(cls), ch)
        moved = F.substring(F.lit(cls), (F.pmod(at - 1 + step, F.lit(len(cls))) + 1).cast("int"), F.lit(1))
        out = F.when(at > 0, moved).otherwise(out)
    return out


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled."""
    n = F.size(digits)
    each = F.transform(digits, lambda c, i: F.when((n - i) % 2 == 0, (c.cast("int") * 2).cast("int")).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: (a + F.when(d > 9, d - 9).otherwise(d)).cast("int"))


def surrogate(kind: Column, key: Column, counter: Column, secret: str, max_rounds: int) -> Column:
    """The replacement of an entity part, in the letters and digits of its key;
    longer, or with octets of any length, from counter ``max_rounds`` on."""
    hashed = F.sha2(F.concat_ws("\x1f", F.lit(secret), kind, key, counter.cast("string")), 512)

    def step(i: Column) -> Column:
        return F.conv(F.substring(hashed, (F.pmod(i, F.lit(32)) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")

    base = F.when(kind == "email", F.substring_index(key, "@", 1)).otherwise(key)
    chars = F.split(base, "")
    n = F.size(chars)
    shifted = F.transform(chars, lambda c, i: _shift(c, step(i), CLASSES))
    plain = F.array_join(shifted, "")
    # first names keep their last letter, domains their last label, IBANs their country
    given = F.concat(F.array_join(F.slice(shifted, 1, F.greatest(n - 1, F.lit(0))), ""), F.substring(base, -1, 1))
    label = F.substring_index(base, ".", -1)
    domain = F.concat(F.array_join(F.slice(shifted, 1, F.greatest(n - F.length(label), F.lit(0))), ""), label)
    iban = F.concat(F.substring(base, 1, 2), F.array_join(F.slice(shifted, 3, F.greatest(n - 2, F.lit(0))), ""))
    secret_key = F.array_join(F.transform(chars, lambda c, i: _shift(c, step(i), HEX_CLASSES)), "")
    low = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
    octets = F.transform(
        F.split(base, r"\."),
        lambda o, i: F.when(F.length(o) == 1, step(i) % low[1][1])
        .when(F.length(o) == 2, step(i) % low[2][1] + low[2][0])
        .otherwise(step(i) % low[3][1] + low[3][0])
        .cast("string"),
    )
    more = F.greatest(counter - max_rounds + 1, F.lit(0))
    octets = F.when(more > 0, F.transform(F.split(base, r"\."), lambda o, i: (step(i) % 256).cast("string"))).otherwise(octets)
    extra = F.array_join(F.transform(F.sequence(F.lit(1), more), lambda j: _shift(chars[0], step(32 - j), CLASSES)), "")
    body = F.slice(shifted, 1, F.greatest(n - 1, F.lit(0)))
    check = ((10 - _luhn(F.concat(body, F.array(F.lit("0")))) % 10) % 10).cast("string")
    card = F.when(_luhn(chars) % 10 == 0, F.concat(F.array_join(body, ""), check)).otherwise(plain)
    same_length = (
        F.when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", card)
        .when(kind.isin("secret", "ipv6"), secret_key)
        .when(kind == "domain", domain)
        .when(kind == "iban", iban)
        .when(kind.startswith("given_"), given)
        .otherwise(plain)
    )
    grown = F.when((more > 0) & kind.isin(*GROWING), extra).otherwise("")
    return F.regexp_replace(same_length, F.lit("(?<=^.)"), grown)


def rendered(form: Column, new: Column) -> Column:
    """``new`` in the layout and case of ``form``; what it is longer than
    ``form`` stands behind the first character."""
    every = F.regexp_replace(new, r"[^\p{L}\p{N}]", "")
    places = F.length(F.regexp_replace(form, r"[^\p{L}\p{N}]", ""))
    over = F.greatest(F.length(every) - places, F.lit(0))
    extra = F.substring(every, F.lit(2), over)
    extra = F.when((form == F.upper(form)) & (places > 1), F.upper(extra)).otherwise(extra)
    signs = F.concat(F.substring(every, 1, 1), F.substring(every, over + 2, F.length(every)))
    chars = F.split(form, "")

    def one(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substring(form, F.lit(1), (i + 1).cast("int")), r"[^\p{L}\p{N}]", ""))
        s = F.substring(signs, nth, F.lit(1))
        s = F.when(s == "", "x").otherwise(s)
        s = F.when(c.rlike(r"\p{Lu}"), F.upper(s)).otherwise(s)
        s = F.when(nth == 1, F.concat(s, extra)).otherwise(s)
        return F.when(c.rlike(r"[\p{L}\p{N}]"), s).otherwise(c)

    return F.array_join(F.transform(chars, one), "")


# Words, with what may stand inside a name, and what is between them.
WORDS = r"[\p{L}'’-]+|[^\p{L}'’-]+"


def with_names(text: Column, names: Column) -> Column:
    """``text`` with the known ``names`` (key, new) replaced wherever one
    stands as a word with a capital; a possessive ending stays."""

    def one(word: Column) -> Column:
        ending = F.regexp_extract(word, "['’]s?$", 0)
        bare = F.substring(word, F.lit(1), F.length(word) - F.length(ending))
        known = F.get(F.filter(names, lambda e: e["key"] == F.lower(bare)), F.lit(0))
        hit = word.rlike(r"^\p{Lu}") & known.isNotNull()
        return F.when(hit, F.concat(rendered(bare, known["new"]), ending)).otherwise(word)

    every = F.regexp_extract_all(text, F.lit(f"({WORDS})"), F.lit(1))
    return F.when(F.size(names) > 0, F.array_join(F.transform(every, one), "")).otherwise(text)


def assign(entities: DataFrame, cfg: SurrogateConfig) -> DataFrame:
    """``entities`` (kind, key, n), distinct, with ``new``, free of collisions
    inside each kind and with the entities themselves."""
    base = F.when(F.col("kind") == "email", F.substring_index("key", "@", 1)).otherwise(F.col("key"))
    now = entities.withColumns({"base": base, "counter": F.lit(0)})
    now = written(now.withColumn("new", surrogate(F.col("kind"), F.col("key"), F.col("counter"), cfg.key, cfg.max_rounds)), "pii-map")
    taken = now.select("kind", F.col("base").alias("new")).distinct()
    for _ in range(cfg.max_rounds + GROWTH_ROUNDS):
        # the part entered longest ago (lowest counter, then key) keeps the surrogate
        owner = now.groupBy("kind", "new").agg(F.min(F.struct("counter", "key")).alias("o"), F.count(F.lit(1)).alias("c"))
        bad = owner.where("c > 1").join(now, ["kind", "new"]).where("key <> o.key").select("kind", "key")
        bad = bad.unionByName(now.join(taken, ["kind", "new"], "left_semi").select("kind", "key")).distinct()
        bad = written(bad, "pii-again")
        if bad.isEmpty():
            break
        mark = bad.withColumn("again", F.lit(1))
        nxt = now.join(mark, ["kind", "key"], "left").withColumn("counter", F.col("counter") + F.coalesce("again", F.lit(0)))
        fresh = surrogate(F.col("kind"), F.col("key"), F.col("counter"), cfg.key, cfg.max_rounds)
        nxt = nxt.withColumn("new", F.when(F.col("again") == 1, fresh).otherwise(F.col("new"))).drop("again")
        now = written(nxt, "pii-map")
    else:
        raise RuntimeError(f"{bad.count()} entities are left without a surrogate of their own")
    return now.select("kind", "key", "n", "new")


def replace(docs: DataFrame, cfg: SurrogateConfig = SurrogateConfig()) -> DataFrame:
    """One row per document row: doc_id, text (entities replaced), n_entities
    and the number of each kind."""
    rows = placed(docs)
    has = F.coalesce(F.col("text").rlike(MAYBE) & F.col("text").rlike(ANY), F.lit(False))
    hit = rows.where(has).select(
        "f", "r", "doc_id",
        F.split("text", ANY, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1)).alias("found"),
    )
    hit = written(hit, "pii-hit")
    mention = hit.select("f", "r", F.posexplode("found").alias("m", "mention")).withColumn("kind", kind_of(F.col("mention")))
    part = mention.select("f", "r", "m", F.col("kind").alias("type"), F.posexplode(parts_of(F.col("kind"), F.col("mention"))).alias("p", "part"))
    part = written(part.select("f", "r", "m", "p", "type", "part.*"), "pii-parts")
    entities = part.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    known = assign(entities, cfg).select(F.struct("kind", "key").alias("id"), "n", "new")
    placed_parts = part.withColumn("id", F.struct("kind", "key"))
    new = join_split(placed_parts, known, "id", "n", max(1, part.count()))
    text = F.concat("pre", F.when(F.col("kind") == "ip", F.col("new")).otherwise(rendered(F.col("form"), F.col("new"))))
    named = F.when(F.col("type") == "name", F.struct("key", "new"))
    per_doc = new.groupBy("f", "r").agg(
        F.array_sort(F.collect_list(F.struct("m", "p", text.alias("text"), "type"))).alias("parts"),
        F.array_sort(F.collect_set(named)).alias("names"),
    )
    both = hit.join(per_doc, ["f", "r"])
    of_mention = lambda i: F.array_join(
        F.transform(F.filter("parts", lambda x: x["m"] == i), lambda x: x["text"]), ""
    )
    body = F.transform("gaps", lambda g, i: F.concat(with_names(g, F.col("names")), F.when(i < F.size("found"), of_mention(i)).otherwise(F.lit(""))))
    firsts = F.filter("parts", lambda x: x["p"] == 0)
    number = lambda k: F.size(F.filter(firsts, lambda x: x["type"] == k)).cast("long").alias(f"n_{k}")
    changed = both.select(
        "doc_id", F.array_join(body, "").alias("text"), F.size("found").cast("long").alias("n_entities"), *[number(k) for k in KINDS]
    )
    none = [F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS]
    same = rows.where(~has).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), *none)
    return same.unionByName(changed)
