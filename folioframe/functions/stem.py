"""English word stems by the Snowball rules (Porter, 2001), as columns of a table of words and for single words, and cover density."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The common English stop list of full-text search (fixed values).
SEARCH_STOP_WORDS = frozenset(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
    it its itself they them their theirs themselves what which who whom this that these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at by for with about
    against between into through during before after above below to from up down in out on off over under again further
    then once here there when where why how all any both each few more most other some such no nor not only own same so
    than too very s t can will just don should now""".split()
)

# The published rules (fixed values): suffixes with what takes their place.
EXCEPTIONS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"} | dict.fromkeys(["sky", "news", "howe", "atlas", "cosmos", "bias", "andes"])
INVARIANT = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
STEP2 = {"tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": ""}
STEP3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion"]
REGION = "^.*?[aeiouy][^aeiouy]"
SPECIAL = "^(?:gener|commun|arsen)"
#: A word's end that is a short syllable, and a whole word that begins with one.
SHORT = "(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
DOUBLED = "(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$"


def any_of(suffixes: list[str] | dict[str, str]) -> str:
    """A pattern of the longest of the suffixes that ends a word."""
    return "(" + "|".join(sorted(suffixes, key=lambda x: (-len(x), x))) + ")$"


def _cut(w: Column, n: int | Column) -> Column:
    return F.left(w, F.length(w) - n)


def stemmed(words: DataFrame, token: str = "token", name: str = "stem") -> DataFrame:
    """The rows of a table of lower-case words with the stem of each: JVM expressions only, a column a step.

    Give distinct words: a text's own are found by joining it with this table, so a word is stemmed once. Words of one or
    two letters stay, and letters beyond a to z are consonants. Null stays null.
    """
    w, p1, p2, suffix, at = (f"stem_{token}_{c}" for c in ("word", "r1", "r2", "suffix", "at"))
    word = lambda: F.col(w)
    df = words.withColumn(w, F.regexp_replace(F.regexp_replace(F.col(token), "^y", "Y"), "([aeiouy])y", "$1Y"))
    # R1 and R2 begin after the first consonant that follows a vowel, R2 within R1; they stay where they are.
    after = lambda x: F.length(x) - F.length(F.regexp_replace(x, REGION, ""))
    df = df.withColumn(p1, F.when(word().rlike(SPECIAL), F.length(word()) - F.length(F.regexp_replace(word(), SPECIAL, ""))).when(word().rlike(REGION), after(word())).otherwise(F.length(word())))
    rest = F.substring(word(), F.col(p1) + 1, F.length(word()))
    df = df.withColumn(p2, F.when(rest.rlike(REGION), F.col(p1) + after(rest)).otherwise(F.length(word())))

    def ending(pattern: str) -> None:
        """The longest suffix of a step, and where it begins."""
        nonlocal df
        df = df.withColumn(suffix, F.regexp_extract(word(), pattern, 1)).withColumn(at, F.length(word()) - F.length(suffix))

    def step(value: Column) -> None:
        nonlocal df
        df = df.withColumn(w, value)

    in1, in2, found, base = F.col(at) >= F.col(p1), F.col(at) >= F.col(p2), F.col(suffix), lambda: F.left(word(), F.col(at))
    ending("(sses|ied|ies|us|ss|s)$")
    step(
        F.when(found == "sses", _cut(word(), 2)).when(found.isin("ied", "ies"), F.when(F.col(at) > 1, _cut(word(), 2)).otherwise(_cut(word(), 1)))
        .when((found == "s") & _cut(word(), 2).rlike("[aeiouy]"), _cut(word(), 1)).otherwise(word())
    )
    stays = F.lower(word()).isin(INVARIANT)
    fixed = f"stem_{token}_fixed"
    df = df.withColumn(fixed, stays)
    ending("(eedly|ingly|edly|eed|ing|ed)$")
    gone = found.isin("ed", "edly", "ing", "ingly") & base().rlike("[aeiouy]")
    df = df.withColumn(f"{w}_gone", gone)
    step(F.when(found.isin("eed", "eedly"), F.when(in1, F.concat(base(), F.lit("ee"))).otherwise(word())).when(F.col(f"{w}_gone"), base()).otherwise(word()))
    short = word().rlike(SHORT) & (F.col(p1) >= F.length(word()))
    step(F.when(~F.col(f"{w}_gone"), word()).when(word().rlike("(?:at|bl|iz)$"), F.concat(word(), F.lit("e"))).when(word().rlike(DOUBLED), _cut(word(), 1)).when(short, F.concat(word(), F.lit("e"))).otherwise(word()))
    step(F.when(word().rlike("^.+[^aeiouy][yY]$"), F.concat(_cut(word(), 1), F.lit("i"))).otherwise(word()))

    def replaced(rules: dict[str, str], held: dict[str, Column]) -> Column:
        """The longest suffix, in R1, by what takes its place; some are held by a further condition."""
        new = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])
        allowed = in1
        for s, condition in held.items():
            allowed = allowed & ((found != s) | condition)
        return F.when((found != "") & allowed, F.concat(base(), F.element_at(new, found))).otherwise(word())

    ending(any_of(STEP2))
    step(replaced(STEP2, {"ogi": base().endswith("l"), "li": base().rlike("[cdeghkmnrt]$")}))
    ending(any_of(STEP3))
    step(replaced(STEP3, {"ative": in2}))
    ending(any_of(STEP4))
    step(F.when((found != "") & in2 & ((found != "ion") | base().rlike("[st]$")), base()).otherwise(word()))
    last = F.length(word()) - 1
    step(
        F.when(word().endswith("e") & ((last >= F.col(p2)) | ((last >= F.col(p1)) & ~_cut(word(), 1).rlike(SHORT))), _cut(word(), 1))
        .when(word().endswith("ll") & (last >= F.col(p2)), _cut(word(), 1)).otherwise(word())
    )
    known = F.create_map(*[F.lit(x) for k, v in EXCEPTIONS.items() for x in (k, v or k)])
    after_1a = F.when(F.col(fixed), F.regexp_extract(F.lower(F.col(token)), "^(" + "|".join(INVARIANT) + ")", 1)).otherwise(F.lower(word()))
    out = df.withColumn(name, F.when(F.length(token) <= 2, F.col(token)).otherwise(F.coalesce(F.try_element_at(known, F.col(token)), after_1a)))
    return out.select(*[c for c in words.columns if c != name], name)


def _region(w: str, start: int) -> int:
    for i in range(start + 1, len(w)):
        if w[i] not in "aeiouy" and w[i - 1] in "aeiouy":
            return i + 1
    return len(w)


def _short(w: str) -> bool:
    v = lambda i: w[i] in "aeiouy"
    return len(w) == 2 and v(0) and not v(1) or len(w) > 2 and not v(-3) and v(-2) and not v(-1) and w[-1] not in "wxY"


@lru_cache(maxsize=10_000)
def stem(word: str) -> str:
    """The stem of one lower-case word: for the few words of a query."""
    if len(word) <= 2 or word in EXCEPTIONS:
        return EXCEPTIONS.get(word) or word
    w = "Y" + word[1:] if word[0] == "y" else word
    for i in range(1, len(w)):
        if w[i] == "y" and w[i - 1] in "aeiouy":
            w = w[:i] + "Y" + w[i + 1 :]
    p1 = next((len(x) for x in ("gener", "commun", "arsen") if w.startswith(x)), _region(w, 0))
    p2 = _region(w, p1)
    end = lambda rules: next((s for s in sorted(rules, key=len, reverse=True) if w.endswith(s)), "")
    s = end(["sses", "ied", "ies", "us", "ss", "s"])
    if s == "sses" or s in ("ied", "ies") and len(w) > 4:
        w = w[:-2]
    elif s in ("ied", "ies") or s == "s" and any(c in "aeiouy" for c in w[:-2]):
        w = w[:-1]
    if w in INVARIANT:
        return w
    s = end(["eedly", "ingly", "edly", "eed", "ing", "ed"])
    base = w[: len(w) - len(s)]
    if s in ("eed", "eedly"):
        w = base + "ee" if len(base) >= p1 else w
    elif s and any(c in "aeiouy" for c in base):
        w = base
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif len(w) > 1 and w[-1] == w[-2] and w[-1] in "bdfgmnprt":
            w = w[:-1]
        elif _short(w) and p1 >= len(w):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    for rules, held in ((STEP2, {"ogi": lambda b: b.endswith("l"), "li": lambda b: b[-1:] and b[-1] in "cdeghkmnrt"}), (STEP3, {"ative": lambda b: len(b) >= p2})):
        s = end(rules)
        base = w[: len(w) - len(s)]
        if s and len(base) >= p1 and (s not in held or held[s](base)):
            w = base + rules[s]
    s = end(STEP4)
    base = w[: len(w) - len(s)]
    if s and len(base) >= p2 and (s != "ion" or base[-1:] in ("s", "t")):
        w = base
    last = len(w) - 1
    if w[-1] == "e" and (last >= p2 or last >= p1 and not _short(w[:-1])) or w.endswith("ll") and last >= p2:
        w = w[:-1]
    return w.lower()


def cover_density(hits: Column, n_terms: int) -> Column:
    """Cover-density rank of an array of (pos, term), by position, for terms 0 to n_terms - 1: 0.1 / (1 + gap) for each
    shortest stretch with all terms that the text has, summed to r; then r / (r + 1).

    After Clarke, Cormack and Tudhope (1999). A text without one of the terms ranks by the terms that it has.
    """
    if n_terms == 1:
        r = F.size(hits) * F.lit(0.1)
        return r / (r + 1)
    need = F.size(F.array_distinct(F.transform(hits, lambda h: h["term"])))
    state = lambda last, held, total, need_: F.struct(last.alias("last"), held.alias("held"), total.alias("total"), need_.alias("need"))
    first = state(F.array_repeat(F.lit(-1), n_terms), F.lit(-1), F.lit(0.0), need)

    def step(acc: Column, h: Column) -> Column:
        last = F.transform(acc["last"], lambda v, j: F.when(j == h["term"], h["pos"]).otherwise(v))
        seen = F.filter(last, lambda v: v >= 0)
        start = F.array_min(seen)
        new = (F.size(seen) == acc["need"]) & (start > acc["held"])
        return state(last, F.when(new, start).otherwise(acc["held"]), acc["total"] + F.when(new, F.lit(0.1) / (1 + (h["pos"] - start) - (acc["need"] - 1))).otherwise(0.0), acc["need"])

    return F.aggregate(hits, first, step, lambda acc: acc["total"] / (acc["total"] + 1))
