"""Personal data replaced by keyed surrogates.

Entities are found by regular expressions. Every different entity (its type and
normal form, so that mentions in other case co-refer) gets a surrogate drawn
from a keyed hash: digits for digits, letters of the same script and case for
letters, punctuation kept, valid card numbers stay valid, IPv4 octets in range,
mail under the reserved ``.example`` domain, names by script and gender. A
dictionary of all entities holds the draws; a surrogate that two entities share,
or that is itself an entity of the corpus, is drawn again for all but the first
of them until none is left, so different entities stay different. Names are
mapped word by word: "Mr. Ada Byron" and "Mrs. Byron" keep one surname. A name is
found by its title; in a text with titled names their words are replaced wherever
they stand, also without a title. In other texts untitled names are not found.

All of it is DataFrame operations. Only the entities of texts that have any are
shuffled with their places, not the texts' other content; texts without entities
pass through. One draw per entity, not per mention, whatever its frequency.

Defined results: null texts stay null and empty ones empty; repeated rows and copies
get the same replacements; columns other than the text are returned as given
(an input column ``n_entities`` is replaced by the count of this operator).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import let, reliable

MALE = ["Mr.", "Sir", "Herr", "Monsieur", "Señor", "г-н", "κ."]
FEMALE = ["Mrs.", "Ms.", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "г-жа", "κα"]
NEUTRAL = ["Dr.", "Prof.", "Doctor", "Professor"]
PARTICLES = "van|von|der|den|de|del|della|di|da|dos|du|la|le|ten|ter|zu|zur|bin|ibn|al|el"
SECRET_WORDS = ["token", "secret", "password", "api"]


def _forms(title: str) -> list[str]:
    """A title as given, in capitals, and (Latin ones) without its dot."""
    return list(dict.fromkeys((title, title.upper(), title.rstrip(".") if title.isascii() else title)))


def _any(titles: list[str]) -> str:
    return "|".join(re.escape(v) for t in titles for v in _forms(t))


_FEMALE, _MALE, _TITLES = _any(FEMALE), _any(MALE), _any([*MALE, *FEMALE, *NEUTRAL])
#: hyphens and apostrophes only between letters, and not that of a possessive
_NAME = r"\p{Lu}(?:\p{L}|[-'’](?=\p{L})(?!s(?!\p{L})))+"
#: type -> pattern; the first that matches at a place wins
PATTERNS = {
    "person": rf"(?<![\p{{L}}])(?:(?:{_TITLES}) )+(?:(?:{PARTICLES}) )*{_NAME}(?: (?:(?:{PARTICLES}) )*{_NAME})*",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])"
              r"|(?<=(?i:token|secret|password|api[_-]?key) {0,2}[=:] {0,2}[\"']?)[0-9A-Za-z_+/-]{12,}",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![0-9])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{13,19})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])"
             r"|(?<![0-9])\+(?=(?:[ .()-]{0,2}[0-9]){8})[0-9]{1,3}(?:[ .-]?(?:[0-9]{1,4}|\([0-9]{1,4}\))){2,}(?![0-9])"
             r"|(?<![0-9])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,}(?![0-9])"
             r"|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?!\.?[0-9])",
}
#: \1 counts groups of the whole expression; the card pattern's is the only capturing one
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())

_ALPHABETS = {"[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
              "[а-яё]": "абвгдежзиклмнопрстуфхцчшэюя", "[А-ЯЁ]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
              "[α-ωά-ώ]": "αβγδεζηθικλμνξοπρστυφχψω", "[Α-Ω]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
              r"\p{Lu}": "ÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ", r"\p{L}": "àáâäèéêëìíîïòóôöùúûü"}
#: name syllables by script; endings by script and gender
_SYLLABLES = {"latin": "ba be da do fe ga ha jo ka la le ma mi na no pe ra ro sa se ta te vi wa".split(),
              "cyrillic": "ба бе да до фе га за ка ла ле ма ми на но пе ра ро са се та те ви".split(),
              "greek": "βα δα δο φε γα κα λα λε μα μι να νο πε ρα ρο σα σε τα τε".split()}
_ENDINGS = {"latin": {"given_m": "n rd s lo".split(), "given_f": "na la ra ne".split(), "given_n": "in ex ay is".split(), "surname": "son ler mann tti".split()},
            "cyrillic": {"given_m": "н р й с".split(), "given_f": "на ла ра я".split(), "given_n": "ша ня".split(), "surname": "нко ук ян швили".split()},
            "greek": {"given_m": "ος ης ων ας".split(), "given_f": "α η ια ινη".split(), "given_n": "ι ω".split(), "surname": "ίδης άκης ου ας".split()}}


def has_entity(text: Column) -> Column:
    """Whether ``ENTITY`` matches. Cheap searches come first: an entity has a digit or
    ``@``, or 32 hexadecimal letters, or follows a title, or a secret word in any case;
    other texts skip the long expression."""
    hint = text.rlike("[0-9@]|[a-f]{32}|[A-F]{32}")
    for t in [*MALE, *FEMALE, *NEUTRAL]:
        for v in _forms(t):
            hint = hint | F.contains(text, F.lit(v + " "))
    for w in SECRET_WORDS:
        hint = hint | F.contains(F.lower(text), F.lit(w))
    return F.coalesce(hint & text.rlike(ENTITY), F.lit(False))


def _pick(options: list[str], h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(h, F.lit(len(options))) + 1).cast("int"))


def _char(alphabet: str, h: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(h, F.lit(len(alphabet))) + 1, F.lit(1))


def _alike(value: Column, seed: Column, digits: str = "0123456789") -> Column:
    """``value`` with every digit and letter drawn anew in its own class."""
    def one(c: Column, i: Column) -> Column:
        h = F.xxhash64(seed, i)
        out = F.when(c.rlike("[0-9]"), _char(digits, h))
        for cls, alphabet in _ALPHABETS.items():
            out = out.when(c.rlike(cls), _char(alphabet, h))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _from_alphabet(value: Column, seed: Column, alphabet: str) -> Column:
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: _char(alphabet, F.xxhash64(seed, i))), "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, from its right end."""
    return F.aggregate(
        F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))),
        F.lit(0), lambda a, x: a + x)


def _card(norm: Column, seed: Column) -> Column:
    """Digits drawn anew; the last one makes a valid number of a valid number."""
    drawn = F.concat(_char("123456789", F.xxhash64(seed, F.lit(-1))), F.substr(_alike(norm, seed), F.lit(2)))

    def fix(d: Column) -> Column:
        head = F.substr(d, F.lit(1), F.length(d) - 1)
        check = F.pmod(10 - F.pmod(luhn_sum(F.concat(head, F.lit("0"))), F.lit(10)), F.lit(10))
        return F.when(F.pmod(luhn_sum(norm), F.lit(10)) == 0, F.concat(head, check.cast("string"))).otherwise(d)

    return let(drawn, fix)


def _name(norm: Column, kind: Column, seed: Column, attempt: Column) -> Column:
    """A name of the script and gender; each new attempt is a syllable longer."""
    def build(script: str, role: str) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.lit(2) + F.least(attempt, F.lit(6))),
                            lambda i: _pick(_SYLLABLES[script], F.xxhash64(seed, i)))
        return F.concat(F.array_join(parts, ""), _pick(_ENDINGS[script][role], F.xxhash64(seed, F.lit(-2))))

    out = None
    for script, cls in (("cyrillic", "[а-яё]"), ("greek", "[α-ωά-ώ]"), ("latin", "")):
        for role in ("given_m", "given_f", "given_n", "surname"):
            cond = norm.rlike(cls) & (kind == role) if cls else kind == role
            out = F.when(cond, build(script, role)) if out is None else out.when(cond, build(script, role))
    return out


def surrogate(kind: Column, norm: Column, attempt: Column, key: str, role: Column | None = None) -> Column:
    """The draw number ``attempt`` for an entity. ``role``: the kind of name, where it is one."""
    role = kind if role is None else role

    def draw(seed: Column) -> Column:
        octet = lambda i, lo, n: (F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(n)) + lo).cast("string")
        local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
        country = F.regexp_extract(norm, r"^(\+[0-9]{1,3}(?=[ (.-])|\+[0-9]|)", 1)
        return (F.when(kind == "email", F.concat(_alike(local, seed), F.lit("@"),
                                                 _alike(F.substring_index(domain, ".", 1), F.concat(seed, F.lit("d"))),
                                                 F.lit(".example")))
                .when(kind == "ip", F.concat_ws(".", octet(1, 1, 223), octet(2, 0, 256), octet(3, 0, 256), octet(4, 1, 254)))
                .when(kind == "phone", F.concat(country, _alike(F.substr(norm, F.length(country) + 1), seed)))
                .when(kind == "card", _card(norm, seed))
                .when(kind == "iban", F.concat(F.substring(norm, 1, 2), _alike(F.substr(norm, F.lit(3)), seed)))
                .when(role.isin(*GIVEN, "surname"), _name(norm, role, seed, attempt))
                .when((kind == "secret") & norm.rlike("^[0-9a-f]+$"), _from_alphabet(norm, seed, "0123456789abcdef"))
                .when((kind == "secret") & norm.rlike("^[0-9A-F]+$"), _from_alphabet(norm, seed, "0123456789ABCDEF"))
                .otherwise(_alike(norm, seed)))

    return let(F.sha2(F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), norm), 256), draw)


def _kind(entity: Column) -> Column:
    out = None
    for k, p in PATTERNS.items():
        p = f"^(?:{p})$"
        out = F.when(entity.rlike(p), F.lit(k)) if out is None else out.when(entity.rlike(p), F.lit(k))
    return out.otherwise(F.lit("secret"))  # the only pattern that needs what stands before it


NAMES = ("given", "surname")
GIVEN = ("given_m", "given_f", "given_n")
_LEADING = f"^(?:(?:{_TITLES}) )+"


def _name_words(person: Column) -> Column:
    """The words of a name with their kinds: the last one is the surname."""
    titled = lambda t: person.rlike(f"^(?:(?:{_TITLES}) )*(?:{t}) ")
    given = F.when(titled(_FEMALE), F.lit("given_f")).when(titled(_MALE), F.lit("given_m")).otherwise(F.lit("given_n"))
    found = F.regexp_extract_all(F.regexp_replace(person, _LEADING, ""), F.lit(_NAME), 0)
    return F.transform(found, lambda w, i: F.struct(
        w.alias("word"), F.when(i == F.size(found) - 1, F.lit("surname")).otherwise(given).alias("kind")))


def _known_names(text: Column) -> Column:
    """(word, kind) of all titled names of a text, longer words first; a word that is both is a surname."""
    persons = F.regexp_extract_all(text, F.lit(PATTERNS["person"]), 0)
    words = F.array_distinct(F.flatten(F.transform(persons, _name_words)))
    return F.transform(F.sort_array(F.transform(words, lambda x: F.struct(
        F.length(x["word"]).alias("n"), x["kind"].alias("kind"), x["word"].alias("word"))), asc=False),
        lambda x: F.struct(x["word"].alias("word"), x["kind"].alias("kind")))


def _with_names(names: Column) -> Column:
    """``ENTITY``, or one of the names as a word of its own, as written, capitalised or in capitals."""
    forms = F.array_distinct(F.flatten(F.transform(names, lambda x: F.array(x["word"], F.initcap(x["word"]), F.upper(x["word"])))))
    return F.when(F.size(names) == 0, F.lit(ENTITY)).otherwise(
        F.concat(F.lit(ENTITY + r"|(?<!\p{L})(?:"), F.array_join(forms, "|"), F.lit(r")(?!\p{L})")))


def _parts(kind: Column, e: Column) -> Column:
    """An entity as pieces (prefix, kind, norm, shown form): names word by word, others whole."""
    s = lambda p, k, n, raw: F.struct(p.alias("prefix"), k.alias("kind"), n.alias("norm"), raw.alias("raw"))
    norm = (F.when(kind.isin("email", *NAMES, *GIVEN), F.lower(e)).when(kind.isin("card", "iban"), F.regexp_replace(e, "[ -]", "")).otherwise(e))

    between = F.split(F.regexp_replace(e, _LEADING, ""), _NAME)
    person = F.transform(_name_words(e), lambda x, i: s(
        F.concat(F.when(i == 0, F.regexp_extract(e, _LEADING, 0)).otherwise(F.lit("")), F.get(between, i)), x["kind"], F.lower(x["word"]), x["word"]))
    return F.when(kind == "person", person).otherwise(F.array(s(F.lit(""), kind, norm, e)))


def _shown(raw: Column, kind: Column, sur: Column) -> Column:
    """The surrogate in the mention's own form: case, and the grouping of card numbers and IBANs."""
    cased = F.when(raw.rlike(r"\p{L}") & (F.upper(raw) == raw) & (kind != "secret") & (F.length(raw) > 1), F.upper(sur)) \
        .when(kind.isin(*NAMES), F.initcap(sur)).otherwise(sur)

    def grouped(chars: Column) -> Column:
        # the n-th character that is not a separator comes from the surrogate
        step = lambda a, c: F.when(c.isin(" ", "-"), F.struct(F.concat(a["s"], c).alias("s"), a["n"].alias("n"))) \
            .otherwise(F.struct(F.concat(a["s"], F.substring(sur, a["n"], F.lit(1))).alias("s"), (a["n"] + 1).alias("n")))
        return F.aggregate(chars, F.struct(F.lit("").alias("s"), F.lit(1).alias("n")), step, lambda a: a["s"])

    return F.when(kind.isin("card", "iban") & raw.rlike("[ -]"), grouped(F.split(raw, ""))).otherwise(cased)


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, sur) for distinct ``entities`` (kind, norm, and for names their role): no
    surrogate twice in a kind, none that is an entity of its kind."""
    role = F.col("role") if "role" in entities.columns else F.col("kind")
    book = entities.select("kind", "norm", role.alias("role"), F.lit(0).alias("attempt"))
    real = entities.select("kind", F.col("norm").alias("sur"), F.lit(True).alias("real"))
    while True:
        book = reliable(book.withColumn("sur", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key, F.col("role"))))
        first = book.groupBy("kind", "sur").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n"))
        clash = first.join(real, ["kind", "sur"], "left").where("n > 1 or real").select("kind", "sur", "first", "real")
        again = reliable(book.join(clash, ["kind", "sur"]).where("real or first.norm <> norm").select("kind", "norm"))
        if not again.limit(1).count():
            return book.select("kind", "norm", "sur")
        book = book.join(again.withColumn("again", F.lit(1)), ["kind", "norm"], "left").select(
            "kind", "norm", "role", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"))


def given_names(places: DataFrame) -> DataFrame:
    """(norm, role) of all given names: the gender that most of the corpus' titles give the name, none where
    no title tells; so a person is one whatever the title of a mention."""
    n = lambda k: F.count_if(F.col("kind") == k)
    return (places.where(F.col("kind").isin(*GIVEN)).groupBy("norm").agg(n("given_f").alias("f"), n("given_m").alias("m"))
            .select("norm", F.when(F.col("f") > F.col("m"), F.lit("given_f")).when(F.col("m") > 0, F.lit("given_m"))
                    .otherwise(F.lit("given_n")).alias("role")))


def replace_pii(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, plus ``n_entities``."""
    columns = [c for c in docs.columns if c != "n_entities"]
    docs = docs.select(*columns)
    some = (docs.where(has_entity(F.col(text))).withColumn("__key", F.md5(F.col(text)))
            .withColumn("__names", _known_names(F.col(text))))
    found = F.regexp_extract_all(F.col(text), _with_names(F.col("__names")), F.lit(0))
    # the kind of a name that stands without a title
    bare = F.get(F.filter("names", lambda x: F.lower(x["word"]) == F.lower(F.col("e"))), F.lit(0))["kind"]
    clean = docs.where(~has_entity(F.col(text))).withColumn("n_entities", F.lit(0).cast("long"))

    places = (some.select("__key", F.struct(found.alias("e"), F.col("__names").alias("names")).alias("x"))
              .groupBy("__key").agg(F.first("x").alias("x"))
              .select("__key", F.posexplode("x.e").alias("at", "e"), F.col("x.names").alias("names"))
              .withColumn("kind", F.coalesce(bare, _kind(F.col("e")))))
    places = reliable(places.select("__key", "at", F.posexplode(_parts(F.col("kind"), F.col("e"))).alias("part", "p"))
                      .select("__key", "at", "part", "p.*"))
    roles = given_names(places).withColumn("kind", F.lit("given"))
    places = places.withColumn("kind", F.when(F.col("kind").isin(*GIVEN), F.lit("given")).otherwise(F.col("kind")))
    book = draw_surrogates(places.select("kind", "norm").distinct().join(roles, ["kind", "norm"], "left")
                           .withColumn("role", F.coalesce("role", "kind")), key)
    shown = F.concat("prefix", _shown(F.col("raw"), F.col("kind"), F.col("sur")))
    whole = (places.join(book, ["kind", "norm"]).groupBy("__key", "at")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col("part"), shown.alias("s")))),
                                           lambda x: x["s"]), "").alias("s"))
             .groupBy("__key").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "s"))), lambda x: x["s"]).alias("__new")))

    def rebuilt(between: Column) -> Column:
        return F.array_join(F.flatten(F.transform(between, lambda b, i: F.array(b, F.coalesce(F.get("__new", i), F.lit(""))))), "")

    done = (some.join(whole, "__key")
            .withColumn("n_entities", F.size("__new").cast("long"))
            .withColumn(text, let(F.split(F.col(text), _with_names(F.col("__names")), -1), rebuilt))
            .select(*columns, "n_entities"))
    return done.unionByName(clean)
