"""PII surrogates (operator 6), DataFrame functions only.

Entities: e-mail and IPv4 addresses, phone, card, social-security and IBAN numbers, secrets
after their name (in any letter case, up to the closing quote or white space), and persons behind a title, to the
end of their name (initials, inner capitals, hyphens, apostrophes, particles), and the bare words of such a name
anywhere in the same text.

Where a name ends: one table counts, over the whole corpus, how often each word behind a title is written with a capital,
in lower case and behind a German determiner, and how many names it opens.  The first word is always part of the name, a
word behind a given name, initials or a particle too.  A stop word ends it, and so does an ordinary word: one
that stands behind a determiner in a quarter of its capitalised uses, or in lower case as often as with a capital (this one
not in a run of two words, as in Mr Rajesh Baker).  A run with a stop word or of more than ``SURE_WORDS`` words
is a title-case sentence or a list: there only words that open a name elsewhere go on.  Bare mentions are replaced for
words of a name that are neither stop words nor ordinary.  Each distinct value gets a keyed surrogate of its
own type: letters stay letters of their script and case, digits digits, punctuation and spacing
stay; an e-mail keeps its top-level domain, a card its first digit and a valid check digit, an
IBAN its country and valid check digits, an address octets below 255; a given name becomes one of the
same gender and script, a surname a surname, the title stays.

Coreference: the surrogate belongs to the canonical value (digits of a number, lower-case e-mail,
single name), so one value written in two formats, and a surname met alone or behind a given
name, stay one.  Distinctness: candidates are grouped by surrogate over the whole corpus; all but one value of
a group, and any candidate equal to a real value, draw again until none collides.

The work is one distinct over the values, joins on values (a value in a third of the documents
makes a skewed join that adaptive execution splits), and a rewrite of the texts that have
entities; the others pass through unshuffled.  A text is cut at its matches and put together
again, so nothing but the matches changes.

Defined results: a null text stays null, an empty one empty; null ids and repeated rows are rewritten like
any other row; an empty table gives an empty result; other columns are unchanged.
"""

from __future__ import annotations

import random

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.tables import packed, row_key, saved

#: Titles by gender, given names by gender and script, syllables and letters by script.
TITLES = {"m": "Mr|Herr|Señor|Sr|Monsieur|Господин", "f": "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Госпожа", "n": "Dr|Prof"}
GIVEN = {
    "latin": {"m": "Adam Boris Carl David Erik Felix Georg Henry Ivan Jonas Karl Leon Martin Noah Oscar Paul Robert Simon Thomas Victor",
              "f": "Anna Berta Clara Diana Emma Flora Greta Hanna Irene Julia Klara Laura Maria Nora Olga Paula Rosa Sara Tina Vera",
              "n": "Alex Ashley Casey Charlie Dana Eden Jamie Jordan Kim Lee Morgan Nikita Quinn Robin Sam Sasha Skyler Taylor Toni Val"},
    "cyrillic": {"m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим", "f": "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Софья",
                 "n": "Женя Саша Валя Шура"},
    "greek": {"m": "Νίκος Γιώργος Πέτρος Κώστας Μάριος", "f": "Ελένη Μαρία Σοφία Άννα Ιωάννα", "n": "Άλεξ Κρις"},
}
SYLLABLES = {"latin": "ba ber dan del fen gar hol kal lin mar nor pel ran sal ten vor wes zan", "cyrillic": "бар вол гор дан кор лев мир нов пет рос сол тар",
             "greek": "βα γορ δαν κας λαμ μαν νικ παπ ραλ στα"}
ENDINGS = {"latin": "berg feld ley mann ner son ton wick", "cyrillic": "ин ов ский енко", "greek": "άκης ίδης όπουλος"}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρτυφχψω"}

_TITLE = "|".join(TITLES.values())
_SECRET = r"(?i:token|secret|passwd|password|api_key|api-key|apikey)"
#: A name of a secret and what stands between it and the value.
_BEFORE = _SECRET + r"""["']?[ \t]{0,4}[=:][ \t]{0,4}"""
PARTICLES = "von van der den dem de del della di da du la le bin ibn al el zu zum zur ter ten dos das do af av".split()
#: A word of a name; the s of a genitive is none of it.  Groups of any length are possessive here and below: the
#: JVM runs these in a loop, others by recursion, which a hostile text takes beyond the stack.
_WORD = r"(?:[dl]['’])?(?:\p{Lu}\.)*+\p{Lu}\p{M}*(?:['’]\p{Lu})?[\p{L}\p{M}]+(?:-\p{Lu}[\p{L}\p{M}]*|['’](?![sS](?!\p{L}))\p{L}[\p{L}\p{M}]*)*+"
_INITIALS = r"(?:\p{Lu}\.(?:-?\p{Lu}\.)*+ )*+"
_PARTICLES = rf"(?:(?:{'|'.join(PARTICLES)}) )*+"
_ONE = rf"{_INITIALS}{_PARTICLES}(?!(?:{_TITLE})\.? ){_WORD}"  # the next title opens another name
_NAME = rf"{_ONE}(?: {_ONE})*+"
_PHONE = r"\+\d{1,3}(?:[ .\-]?\(?\d{2,4}\)?){2,4}"
_MAIL = r"[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63})++"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: The patterns of the entity types.
PATTERNS = [
    rf"""(?<=[=:][ \t]{{0,4}}["'])(?:(?<={_BEFORE}")(?=[^"\r\n]*[\p{{L}}\p{{N}}])(?:[^"\r\n]+(?=")|[^\s"]+)|(?<={_BEFORE}')(?=[^'\r\n]*[\p{{L}}\p{{N}}])(?:[^'\r\n]+(?=')|[^\s']+))""",
    rf"""(?<=[=:][ \t]{{0,4}})(?<={_BEFORE})(?=[^\s"']*[\p{{L}}\p{{N}}])[^\s"']*[^\s"',;.)\]}}>]""",
    rf"""(?<=[=:\s"'])(?=[A-Za-z0-9+/_\-]{{16}})(?<={_SECRET}\s{{0,2}}[=:]\s{{0,2}}["']?)(?=[A-Za-z+/_\-]*\d)[A-Za-z0-9+/_\-]{{16,}}""",
    r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63})++",
    r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    r"(?<![\w+])\+\d{1,3}(?:[ .\-]?\(?\d{2,4}\)?){2,4}(?!\w)",
    r"(?<![\w(])\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}(?!\w)",
    r"(?<![\w.])(?:\d{4}[ \-]){3}\d{4}(?!\w)|(?<![\w.])\d{13,19}(?!\w)",
    r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    rf"(?<!\p{{L}})(?:{_TITLE})\.? {_NAME}",
]
#: No entity starts behind a letter: one look spares the nine patterns most places of a text.
ENTITY = "(?<![A-Za-z])(?:" + "|".join(f"(?:{p})" for p in PATTERNS) + ")"
#: What every entity has: a digit, an @, the name of a secret or a title.
HINT = rf"""[0-9@]|{_SECRET}["']?[ \t]{{0,4}}[=:]|(?<![A-Za-z])(?:{_TITLE})\.? """
#: A word that may be the bare mention of a name.
BARE = rf"(?<![\p{{L}}\p{{M}}]){_WORD}(?![\p{{L}}\p{{M}}])"
FILLED = ["phone", "card", "ssn", "iban"]
TRIES = 64
#: Words of a run beyond which each must be confirmed as a name.
SURE_WORDS = 4
#: Words behind which German has a common noun.
DETERMINERS = "der die das den dem des ein eine einen einem einer eines am im zum zur beim vom ins".split()
#: What stands between the words of a text; quotes, hyphens and a genitive s at a word's end are none of it.
_GAP = r"(?:[^\p{L}\p{M}'’\-]|['’][sS](?![\p{L}\p{M}])|['’\-](?![\p{L}\p{M}])|(?<![\p{L}\p{M}])['’\-])+"
_CAPITAL = r"^(?:[dl]['’])?\p{Lu}"


def entities(text: Column) -> Column:
    """All matches in order; empty for a null text.  A cheap test spares most texts the long pattern."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind_of(v: Column) -> Column:
    return (F.when(v.rlike(rf"^{_MAIL}$"), "email").when(v.rlike(rf"^(?:{_TITLE})\.? {_NAME}$"), "name").when(v.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
            .when(v.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(v.rlike(rf"^{_PHONE}$") | v.rlike(r"^\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}$"), "phone")
            .when(v.rlike(r"^(?:(?:\d{4}[ \-]){3}\d{4}|\d{13,19})$"), "card").when(v.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$"), "iban").otherwise("secret"))


def stop_words() -> list[str]:
    """Spark's own lists, less the particles of names."""
    lists = [StopWordsRemover.loadDefaultStopWords(x) for x in ("english", "german", "french", "spanish", "russian")]
    return sorted({w for x in lists for w in x} - set(PARTICLES))


def _usual(w: Column) -> Column:
    """A word in capitals is the same name as in its usual case."""
    return F.when((w == F.upper(w)) & ~w.rlike(r"[^\p{L}\p{M}]"), F.initcap(F.lower(w))).otherwise(w)


def name_words(values: DataFrame) -> DataFrame:
    """A row per word of the name values: _v, n (place), word, prev, key, first (1 + place of the first real word), many (real
    words), guarded, gender, small (initials or particle), stop.  The value itself, which may be long, is not repeated."""
    stops = stop_words()
    small = lambda w: w.rlike(r"^(?:\p{Lu}\.-?)+$") | w.isin(PARTICLES)
    v = F.col("value")
    gender = F.when(v.rlike(rf"^(?:{TITLES['m']})\.? "), "given_m").when(v.rlike(rf"^(?:{TITLES['f']})\.? "), "given_f").otherwise("given_n")
    runs = saved(values.filter("kind = 'name'").select("_v", gender.alias("gender"), F.split(F.regexp_replace(v, rf"^(?:{_TITLE})\.? ", ""), " ").alias("words"))
                 .withColumn("real", F.filter("words", lambda w: ~small(w)))
                 .select("_v", "gender", "words", F.size("real").alias("many"), F.array_position("words", F.get("real", F.lit(0))).alias("first"),
                         F.exists(F.slice("real", 2, 2**31 - 1), lambda w: F.lower(w).isin(stops)).alias("_s"))
                 .withColumn("guarded", F.col("_s") | (F.col("many") > SURE_WORDS)).drop("_s"), "runs")
    each = F.transform("words", lambda w, i: F.struct(w.alias("word"), F.when(i > 0, F.get("words", i - 1)).alias("prev")))
    return (runs.select("_v", "gender", "many", "first", "guarded", F.posexplode(each).alias("n", "_w")).select("_v", "gender", "many", "first", "guarded", "n", "_w.word", "_w.prev")
            .withColumn("key", F.lower("word")).withColumn("small", small(F.col("word"))).withColumn("stop", F.col("key").isin(stops)))


def word_counts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """key, n_cap, n_low, n_det: uses of the words ``keys`` in all of ``texts`` (column _t): with a capital, without, and with one behind a determiner."""
    each = lambda: F.transform("_w", lambda w, i: F.struct(F.lower(w).alias("key"), w.rlike(_CAPITAL).alias("cap"),
                                                           F.when(i > 0, F.lower(F.get("_w", i - 1)).isin(DETERMINERS)).otherwise(False).alias("det")))
    words = texts.select(F.split("_t", _GAP, -1).alias("_w")).select(F.explode(each()).alias("_x")).select("_x.*")
    # Added up in the tasks first: a word's uses never meet in one place, the vocabulary is shuffled once.
    counts = words.groupBy("key").agg(F.count_if("cap").alias("n_cap"), F.count_if(~F.col("cap")).alias("n_low"), F.count_if(F.col("cap") & F.col("det")).alias("n_det"))
    return counts.join(keys, "key", "left_semi")


def parts_of(values: DataFrame, texts: DataFrame) -> DataFrame:
    """_v, kind, value (null for a name), n (place of the part), part kind, canonical part, the part as written, bare (a mention alone counts)."""
    kinds = values.filter("kind <> 'name'")
    v, kind = F.col("value"), F.col("kind")
    plain = F.when(kind == "email", F.lower(v)).when(kind.isin(FILLED), F.upper(F.regexp_replace(v, "[^0-9A-Za-z]", ""))).otherwise(v)
    others = kinds.select("_v", "kind", "value", F.lit(0).alias("n"), kind.alias("part"), plain.alias("canon"), v.alias("word"), F.lit(False).alias("bare"))
    if values.filter("kind = 'name'").isEmpty():
        return others
    words = saved(name_words(values), "words")
    keys = saved(words.filter("NOT small").groupBy("key").agg(F.count_if(F.col("n") + 1 == F.col("first")).alias("n_first")), "keys")
    known = keys.join(word_counts(texts, keys), "key", "left").fillna(0, ["n_cap", "n_low", "n_det"])
    words = words.join(saved(known, "known"), "key", "left")
    noun = (F.col("n_det") > 0) & (4 * F.col("n_det") >= F.col("n_cap"))
    lower = (F.col("n_low") > 0) & (F.col("n_low") >= F.col("n_cap"))
    men, women = (GIVEN["latin"][g].split() + GIVEN["cyrillic"][g].split() for g in "mf")
    given = lambda w: _usual(w).isin(men + women)
    before = F.col("prev").rlike(r"^(?:\p{Lu}\.-?)+$") | F.col("prev").isin(PARTICLES) | given(F.col("prev"))
    goes_on = (F.when(F.col("small") | (F.col("n") + 1 <= F.col("first")), True).when(F.col("stop"), False).when(before, True).when(noun | (lower & (F.col("many") != 2)), False)
               .when(F.col("guarded"), F.col("n_first") > 0).otherwise(True))
    words = saved(words.withColumn("on", goes_on).withColumn("bare", ~F.col("stop") & ~noun & ~lower), "words")
    ends = words.groupBy("_v").agg(F.min(F.when(~F.col("on"), F.col("n"))).alias("end"), F.max(F.when(~F.col("small"), F.col("n"))).alias("last"))
    last = F.coalesce(F.col("end") - 1, F.col("last"))
    word = F.col("word")
    part = (F.when(F.col("n") > last, "plain").when(word.rlike(r"^(?:\p{Lu}\.-?)+$"), "initials").when(word.isin(PARTICLES), "particle").when(F.col("n") == last, "surname")
            .when(_usual(word).isin(men), "given_m").when(_usual(word).isin(women), "given_f").otherwise(F.col("gender")))
    named = words.join(ends, "_v").select("_v", F.lit("name").alias("kind"), F.lit(None).cast("string").alias("value"), "n", part.alias("part"),
                                          _usual(word).alias("canon"), "word", F.coalesce("bare", F.lit(False)).alias("bare"))
    return others.unionByName(named)


def _draw(secret: str, *more: Column) -> Column:
    """A keyed non-negative integer of 32 bits."""
    text = F.concat_ws("|", F.lit(secret), F.col("part"), F.col("canon"), F.col("attempt").cast("string"), *[m.cast("string") for m in more])
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def _pick(words: str, n: Column) -> Column:
    items = words.split()
    return F.element_at(F.array(*[F.lit(w) for w in items]), (F.pmod(n, F.lit(len(items))) + 1).cast("int"))


def _by_script(of) -> Column:
    c = F.col("canon")
    return F.when(c.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(c.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))


def _masked(secret: str) -> Column:
    """The canonical value with each letter and digit drawn anew; what must stay by type stays."""
    canon, part = F.col("canon"), F.col("part")
    size = F.length(canon)
    tail = F.length(F.substring_index(canon, ".", -1))
    stays = lambda i: (((part == "email") & (i >= size - tail)) | (part.isin("card", "phone") & (i == 0) & (size > 10)) | ((part == "iban") & (i < 2)))

    def one(c: Column, i: Column) -> Column:
        n = _draw(secret, i)
        out = F.when(stays(i), c).when(c.rlike("^[0-9]$"), F.pmod(n, F.lit(10)).cast("string"))
        for letters in LETTERS.values():
            low = F.substr(F.lit(letters), (F.pmod(n, F.lit(len(letters))) + 1).cast("int"), F.lit(1))
            out = out.when(F.lit(letters).contains(c), low).when(F.lit(letters.upper()).contains(c), F.upper(low))
        # Letters and digits outside these alphabets must not stay in a secret.
        other = F.substr(F.lit(LETTERS["latin"]), (F.pmod(n, F.lit(26)) + 1).cast("int"), F.lit(1))
        return out.when((part == "secret") & c.rlike(r"[\p{L}\p{N}]"), other).otherwise(c)

    return F.concat_ws("", F.transform(F.split(canon, ""), one))


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn rule, modulo 10."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.floor(c.cast("int") * 2 / 10).cast("int") + F.pmod(c.cast("int") * 2, F.lit(10))))
    return F.pmod(F.aggregate(each, F.lit(0), lambda a, x: a + x), F.lit(10))


def _mod97(text: Column) -> Column:
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(c.rlike("^[0-9]$"), F.pmod(a * 10 + c.try_cast("int"), F.lit(97)))
                       .otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97))))


def candidate(secret: str) -> Column:
    """The surrogate of (part, canon) at this attempt."""
    part, canon, again = F.col("part"), F.col("canon"), F.col("attempt")
    draw = _draw(secret)
    more = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), again)), lambda i: _by_script(lambda s: _pick(SYLLABLES[s], _draw(secret, i)))))
    given = lambda g: F.concat(_by_script(lambda s: _pick(GIVEN[s][g], draw)), F.when(again > 0, more).otherwise(""))
    surname = F.initcap(F.concat(more, _by_script(lambda s: _pick(SYLLABLES[s], _draw(secret, F.lit("s")))), _by_script(lambda s: _pick(ENDINGS[s], draw))))
    masked = _masked(secret)
    longer = F.when(again >= 8, F.concat(F.lit("x"), F.conv(draw.cast("string"), 10, 36))).otherwise("")  # small formats run out
    longer = F.lower(longer)
    body = F.substr(masked, F.lit(1), F.length(masked) - 1)
    check = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    card = F.when(_luhn(canon) == 0, F.concat(body, check)).otherwise(masked)
    bban = F.substr(masked, F.lit(5))
    iban = F.concat(F.substring(masked, 1, 2), F.lpad((F.lit(98) - _mod97(F.concat(bban, F.substring(masked, 1, 2), F.lit("00")))).cast("string"), 2, "0"), bban)
    ip = F.concat_ws(".", F.transform(F.split(canon, r"\."), lambda c, i: (F.pmod(_draw(secret, i), F.lit(254)) + 1).cast("string")))
    return (F.when(part == "given_m", given("m")).when(part == "given_f", given("f")).when(part == "given_n", given("n")).when(part == "surname", surname)
            .when(part == "ip", ip).when(part == "card", card).when(part == "iban", iban).when(part.isin("phone", "ssn"), masked)
            .otherwise(F.concat(longer, masked)))


def resolve(parts: DataFrame, secret: str) -> DataFrame:
    """part, canon, surrogate: one for each canonical value, no two alike within a type and none a real value of the type."""
    parts = saved(parts.select("part", "canon").distinct(), "canon")
    real = parts.select(F.col("part").alias("_p"), F.col("canon").alias("_c"))
    pending, done = parts.withColumn("attempt", F.lit(0)), None
    for attempt in range(TRIES):
        cand = saved(pending.withColumn("surrogate", candidate(secret)), "cand")
        free = cand.join(real, (F.col("part") == F.col("_p")) & (F.col("surrogate") == F.col("_c")), "left_anti")
        if done is not None:
            free = free.join(done.select(F.col("part").alias("_p"), F.col("surrogate").alias("_s")), (F.col("part") == F.col("_p")) & (F.col("surrogate") == F.col("_s")), "left_anti")
        won = free.groupBy("part", "surrogate").agg(F.min("canon").alias("canon")).select("part", "canon", "surrogate")
        done = saved(won if done is None else done.unionByName(won), "done")
        pending = cand.join(done, ["part", "canon"], "left_anti").select("part", "canon", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return done
    raise RuntimeError("a type has more values than its format has surrogates")


def other_letters(secret: str, initials: Column) -> Column:
    """Initials in other letters of their script: one to one, so that distinct initials stay distinct."""
    for letters in LETTERS.values():
        order = list(letters.upper())
        random.Random(f"{secret}|{letters}").shuffle(order)
        initials = F.translate(initials, "".join(order), "".join(order[1:] + order[:1]))  # no letter stays
    return initials


def formatted() -> Column:
    """The surrogate of a part in the format of the value it stands for (columns value, kind, word, surrogate)."""
    v, s = F.col("value"), F.col("surrogate")
    zero = F.struct(F.lit("").alias("o"), F.lit(1).alias("j"))
    fill = F.aggregate(F.split(v, ""), zero, lambda a, c: F.when(c.rlike("^[0-9A-Za-z]$"), F.struct(
        F.concat(a["o"], F.when(c.rlike("^[a-z]$"), F.lower(F.substr(s, a["j"], F.lit(1)))).otherwise(F.substr(s, a["j"], F.lit(1)))).alias("o"), (a["j"] + 1).alias("j")))
        .otherwise(F.struct(F.concat(a["o"], c).alias("o"), a["j"].alias("j"))), lambda a: a["o"])
    cased = F.concat_ws("", F.zip_with(F.split(v, ""), F.split(s, ""), lambda c, x: F.when(c.rlike("^[A-Z]$"), F.upper(x)).otherwise(x)))
    loud = (F.col("kind") == "name") & (F.col("word") != F.col("canon"))
    return F.when(F.col("kind").isin(FILLED), fill).when((F.col("kind") == "email") & (F.length(v) == F.length(s)), cased).when(loud, F.upper(s)).otherwise(s)


def surrogate_table(docs: DataFrame, text_col: str = "text", secret: str = "parcelle") -> DataFrame:
    """value, kind, replacement for every distinct entity of ``docs``."""
    texts = docs.select(F.col(text_col).alias("_t"))
    return replacements(texts.select(F.explode_outer(F.array_distinct(entities(F.col("_t")))).alias("value")), texts, secret)


def replacements(found: DataFrame, texts: DataFrame, secret: str) -> DataFrame:
    """value, kind, replacement and bare (the single words of a name, with their surrogates) for every distinct entity in the column value;
    ``texts`` (column _t): the whole corpus, whose words decide where names end."""
    values = saved(found.filter("value is not null").select("value").distinct().select("value", kind_of(F.col("value")).alias("kind"), F.sha2("value", 256).alias("_v")), "values")
    parts = saved(parts_of(values, texts), "parts")
    kept = parts.part.isin("initials", "particle", "plain")
    rows = parts.filter(~kept).join(resolve(parts.filter(~kept), secret), ["part", "canon"]).withColumn("r", formatted())
    rows = rows.drop("surrogate").unionByName(parts.filter(kept).withColumn("r", F.when(F.col("part") == "initials", other_letters(secret, F.col("word"))).otherwise(F.col("word"))))
    sorted_parts = F.array_sort(F.collect_list(F.struct("n", "r")))  # the parts of one value
    single = F.collect_list(F.when(F.col("bare") & ~F.col("part").isin("initials", "particle", "plain"), F.struct("part", F.col("canon").alias("word"), F.col("r").alias("new"))))
    whole = F.concat_ws(" ", F.transform(sorted_parts, lambda x: x["r"]))
    title = F.regexp_extract("value", rf"^(?:{_TITLE})\.? ", 0)
    return (rows.groupBy("_v").agg(whole.alias("r"), single.alias("bare")).join(values, "_v")
            .select("value", "kind", F.concat(F.when(F.col("kind") == "name", title).otherwise(""), F.col("r")).alias("replacement"), "bare"))


def pseudonymize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", secret: str = "parcelle", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity replaced; ``count_col``: adds the number of entities replaced (of this name)."""
    rows = packed(docs, id_col, text_col)
    text = F.col("_row").getField(text_col)
    # The entities are searched once and written; explode_outer, as explode would have the search repeated in a filter below it.
    found = saved(rows.select("_id", "_h", F.explode_outer(F.array_distinct(entities(text))).alias("value")).filter("value is not null"), "found")
    table = saved(replacements(found, docs.select(F.col(text_col).alias("_t")), secret).select("value", "replacement", "bare"), "surrogates")
    pairs = found.distinct().join(table, "value")
    maps = pairs.groupBy("_id", "_h").agg(F.map_from_entries(F.collect_list(F.struct("value", "replacement"))).alias("_m"))  # the entities of one text
    # One surrogate a word: as a surname, if it is one in this text.
    mentions = (pairs.select("_id", "_h", F.explode("bare").alias("b")).groupBy("_id", "_h", "b.word").agg(F.max_by("b.new", "b.part").alias("new"))
                .groupBy("_id", "_h").agg(F.map_from_entries(F.collect_list(F.struct("word", F.initcap("new").alias("new")))).alias("_b")))
    maps = maps.join(mentions, ["_id", "_h"], "left")
    has = F.coalesce(text.rlike(HINT) & text.rlike(ENTITY), F.lit(False))
    every = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    pieces = F.split(text, ENTITY, -1)
    words = lambda p: F.regexp_extract_all(p, F.lit(BARE), F.lit(0))
    usual = lambda w: F.coalesce(F.element_at("_b", w), F.when(w == F.upper(w), F.upper(F.element_at("_b", F.initcap(F.lower(w))))))
    told = F.transform(pieces, lambda p: F.concat_ws("", F.zip_with(F.split(p, BARE, -1), F.concat(
        F.transform(words(p), lambda w: F.coalesce(usual(w), w)), F.array(F.lit(""))), lambda q, w: F.concat(q, w))))
    named = F.col("_b").isNotNull()
    n_bare = F.when(named, F.aggregate(pieces, F.lit(0), lambda a, p: a + F.size(F.filter(words(p), lambda w: usual(w).isNotNull())))).otherwise(F.lit(0))
    new = F.concat_ws("", F.zip_with(F.when(named, told).otherwise(pieces), F.concat(F.transform(every, lambda e: F.element_at("_m", e)), F.array(F.lit(""))),
                                     lambda p, s: F.concat(p, s)))
    done = rows.filter(has).join(maps, ["_id", "_h"]).select("_row", new.alias("_new"), (F.size(every) + n_bare).alias("_n"))
    out = done.unionByName(rows.filter(~has).select("_row", text.alias("_new"), F.lit(0).alias("_n")))
    cols = [(F.col("_new") if c == text_col else F.col("_row").getField(c)).alias(c) for c in docs.columns]
    return out.select(*cols, *([F.col("_n").cast("long").alias(count_col)] if count_col else []))
