"""Text as columns: tokens, n-grams, classifiers, normalisation, sections, keyword scores.

A null text is read as an empty one unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fold import decomposed

WORD = r"[\p{L}\p{M}\p{N}_]+"
# Opening moves by anchored pattern, categories and trait words by keyword, words that name a trait.
OPENING_MOVES = {
    "situational_hook": "^(după|în|sâmbăta|duminica|la|când)",
    "preference_statement": "^(preferă|îi place|evită|nu îi place|apreciază)",
    "micro_story": "^(sâmbăta trecută|recent|acum câteva zile|vara trecută)",
    "contrast": "^(deși|chiar dacă|cu toate că|totuși)",
    "value": "^(ține|prețuiește|cont[eă]ază|îi pasă)",
    "sensory_anchor": "^(mirosul|sunetul|gustul|imaginea|senzația)",
}
CONSTRAINTS = {
    "budget": ["buget", "bani", "economii", "ieftin", "scump"],
    "time_pressure": ["timp", "grabă", "ocupat", "program", "deadline"],
    "family_duty": ["familie", "copii", "nepoți", "părinți", "responsabil"],
    "health_nuisance": ["durere", "spate", "somn", "oboseală", "sănătate"],
    "commute_burden": ["drum", "navetă", "maxi-taxi", "autobuz", "trafic"],
    "bureaucratic_fatigue": ["hârtii", "birocrație", "primărie", "instituție"],
}
TRAIT_WORDS = {
    "openness": (["creativ", "curios", "imaginație", "artă", "călătorii", "noutate", "experiment", "filozofic", "abstract"], ["practic", "tradițional", "concret", "obișnuit", "sigur", "predictibil"]),
    "conscientiousness": (["organizat", "disciplinat", "planific", "precis", "responsabil", "meticulos", "punctual", "structurat"], ["spontan", "relaxat", "flexibil", "improvizează", "dezorganizat"]),
    "extraversion": (["sociabil", "extrovertit", "energic", "vorbăreț", "petreceri", "grupuri", "entuziast", "asertiv"], ["introvertit", "rezervat", "solitar", "liniștit", "introspectiv", "tăcut"]),
    "agreeableness": (["amabil", "cooperant", "empatic", "înțelegător", "generos", "ajută", "armonios", "diplomatic"], ["competitiv", "direct", "critic", "sceptic", "dur", "confruntațional"]),
    "neuroticism": (["anxios", "stresat", "îngrijorat", "emoțional", "sensibil", "nervos", "fricos", "temător"], ["calm", "stabil", "relaxat", "încrezător", "rezilient", "echilibrat", "liniștit"]),
}
LEAKING_WORDS = [
    "deschis", "deschisa", "deschisă",
    "conștiincios", "conștiincioasă", "constiincios",
    "extrovertit", "extrovertită", "extravert",
    "agreabil", "agreabilă",
    "nevrotic", "nevrotică",
    "trăsătură", "trăsături",
    "personalitate", "tipar",
    "big five", "ocean", "oceam",
    "scor", "t_score", "t-score", "tscore",
    "procentil", "percentil",
    "neurotic", "neurotica", "neurotică",
    "conscientios", "constiincioasa",
]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once even where use has it in a lambda, which would compute it for each entry."""
    return F.transform(F.array(value), use)[0]


def lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def quoted(words: Sequence[str]) -> str:
    """One pattern that finds any of the words, taken literally."""
    return "|".join("\\Q" + w + "\\E" for w in words)


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters, marks, digits and underscores."""
    return F.regexp_extract_all(lower(text), F.lit(WORD), F.lit(0))


def joined_tokens(text: Column) -> Column:
    """The tokens with one space between them."""
    return F.array_join(tokens(text), " ")


def ngrams(words: Column, n: int) -> Column:
    """Space-joined runs of n words with repeats; empty if there are fewer."""

    def runs(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - n + 1)
        return F.when(F.size(w) >= n, F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return let(words, runs)


def shingles(text: Column, k: int = 3) -> Column:
    return F.array_distinct(ngrams(tokens(text), k))


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[.!?]+"), lambda s: F.trim(s)), lambda s: s != "")


def first_sentence(text: Column, chars: int = 50) -> Column:
    low = lower(text)
    return F.when(F.contains(low, F.lit(".")), F.substring_index(low, ".", 1)).otherwise(F.substring(low, 1, chars))


def first_match(value: Column, patterns: Mapping[str, str], other: str = "other") -> Column:
    """Name of the first pattern that is found in value."""
    out = F.lit(other)
    for name, pattern in reversed(list(patterns.items())):
        out = F.when(value.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def opening_move(text: Column, patterns: Mapping[str, str] = OPENING_MOVES) -> Column:
    return first_match(first_sentence(text), patterns)


def keyword_class(text: Column, keywords: Mapping[str, Sequence[str]] = CONSTRAINTS) -> Column:
    return first_match(lower(text), {k: quoted(v) for k, v in keywords.items()})


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return lower(text).rlike(quoted(words))


def found_words(text: Column, words: Sequence[str] = tuple(LEAKING_WORDS)) -> Column:
    """Those of the words, in their order, that the text contains."""
    return let(lower(text), lambda low: F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(low, w)))


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern))


# The letters with marks of Romanian, Gagauz, French, German and Spanish.
MARKED, BARE = "ăâîșşțţéèêëàáçíïóôöúùûüñä", "aaisstteeeeaaciiooouuuuna"


def fold_marks(text: Column) -> Column:
    """Lower case without the marks of MARKED; general decomposition is nfkd()."""
    return F.translate(lower(text), MARKED, BARE)


def normalise(text: Column) -> Column:
    """Without marks and punctuation, white space squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(fold_marks(text), r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def normalise_place(text: Column) -> Column:
    """Without marks, points and commas, white space squeezed, and the word for municipality shortened, also before a name."""
    short = F.regexp_replace(F.trim(nfkd(F.coalesce(text, F.lit("")))), r"\b(?:municipiul|municipiu)\b", "mun")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(short, r"\bmun\.\s*", "mun "), "[.,]", ""), r"\s+", " ")


def nfkd(text: Column) -> Column:
    """Lower case, compatibility decomposition, no combining marks."""
    return decomposed(F.lower(text))


# What stands in the label of a total.
TOTAL_LABELS = ["total", "total pe tara", "total general", "total population", "populatia totala", "populatia total", "whole country", "country"]


def is_total(text: Column, labels: Sequence[str] = tuple(TOTAL_LABELS)) -> Column:
    return let(normalise_place(text), lambda norm: F.exists(F.array(*map(F.lit, labels)), lambda p: F.contains(norm, p)))


# What stands before the path of a dataset, and languages that may begin it.
PATH_MARKERS, PATH_LANGUAGES = ["/PxWeb/pxweb/", "/pxweb/", "/PxWeb/api/v1/"], ["ro", "en"]


def clean_path(path: Column, markers: Sequence[str] = tuple(PATH_MARKERS), languages: Sequence[str] = tuple(PATH_LANGUAGES)) -> Column:
    """The path of a dataset from a URL, a path with a marker, or as it is.

    Decoded; what follows the first marker found; without a leading language, and without a first part that the
    second repeats before its double underscore; double underscores separate parts.
    """
    raw = F.trim(F.coalesce(path, F.lit("")))
    bare = F.try_url_decode(F.replace(F.when(F.contains(raw, F.lit("://")), F.coalesce(F.try_parse_url(raw, F.lit("PATH")), F.lit(""))).otherwise(raw), F.lit("+"), F.lit("%2B")))
    after = F.coalesce(bare, raw)
    for m in reversed(markers):
        after = F.when(F.contains(F.coalesce(bare, raw), F.lit(m)), F.regexp_replace(F.coalesce(bare, raw), r"(?s)^.*?\Q" + m + r"\E", "")).otherwise(after)
    parts = F.filter(F.split(after, "/"), lambda p: p != "")
    spoken = let(parts, lambda p: F.when(F.get(p, F.lit(0)).isin(list(languages)), F.slice(p, 2, 10_000)).otherwise(p))
    twice = let(spoken, lambda p: F.when(F.contains(F.get(p, F.lit(1)), F.lit("__")) & (normalise(F.substring_index(F.get(p, F.lit(1)), "__", 1)) == normalise(F.get(p, F.lit(0)))), F.slice(p, 2, 10_000)).otherwise(p))
    return F.array_join(F.filter(F.flatten(F.transform(twice, lambda p: F.split(p, "__"))), lambda p: p != ""), "/")


def trait_scores(text: Column, words: Mapping[str, tuple[Sequence[str], Sequence[str]]] = TRAIT_WORDS) -> Column:
    """Struct of a 0..100 score for each trait and a confidence, from distinct keyword hits.

    Five points for each hit more on the high side, at most 20 either way, or 10
    with fewer than two hits. Confidence expects one keyword in ten words; 0 and
    50 all over for an empty text.
    """
    words_ = tokens(fold_marks(text))
    fold = lambda ws: F.array(*[F.lit(w.translate(str.maketrans(MARKED, BARE))) for w in ws])
    fields, hits = [], F.lit(0)
    for trait, (high, low) in words.items():
        up, down = (F.size(F.array_intersect(words_, fold(ws))) for ws in (high, low))
        top = F.when(up + down < 2, 10).otherwise(20)
        fields.append(F.least(F.lit(100), F.greatest(F.lit(0), 50 + F.least(top, F.greatest(-top, 5 * (up - down))))).cast("int").alias(trait))
        hits = hits + up + down
    n = F.size(words_)
    confidence = F.when(n == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), hits / F.greatest(F.lit(1.0), n * 0.1)))
    return F.struct(*fields, confidence.alias("confidence"))


def deviation(target: Sequence[Column], inferred: Sequence[Column]) -> Column:
    """Largest difference between two sets of scores."""
    return F.greatest(*[F.abs(a - b) for a, b in zip(target, inferred, strict=True)])


def section(text: Column, marker: str, markers: Sequence[str]) -> Column:
    """What stands after [marker] up to the next of the markers, without dashes and spaces around it."""
    ahead = "|".join("\\[\\Q" + m + "\\E\\]" for m in markers)
    body = F.regexp_extract(F.coalesce(text, F.lit("")), "(?s)\\[\\Q" + marker + "\\E\\](.*?)(?=" + ahead + "|\\z)", 1)
    return F.regexp_replace(body, r"^[\s-]+|[\s-]+$", "")


def header_sections(text: Column) -> Column:
    """Map from each header line (ending in a colon) to the lines below it."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    start = F.struct(F.lit("").alias("h"), F.array().cast("array<struct<h:string,l:string>>").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        head = F.rlike(line, F.lit(r"^[^:]{1,60}:\s*$"))
        h = F.when(head, F.regexp_replace(F.trim(line), ":$", "")).otherwise(acc["h"])
        return F.struct(h.alias("h"), F.when(head | (F.trim(line) == ""), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(h.alias("h"), F.trim(line).alias("l"))))).alias("out"))

    def gathered(pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(pairs, lambda p: p["h"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_join(F.transform(F.filter(pairs, lambda p: p["h"] == k), lambda p: p["l"]), "\n")))

    return let(F.aggregate(lines, start, step, lambda acc: acc["out"]), gathered)


def parsed_sections(text: Column, markers: Sequence[str]) -> Column:
    """Map of sections by markers, else by header lines, else the whole text under the first marker."""
    by_marker = F.create_map(*[x for m in markers for x in (F.lit(m), section(text, m, markers))])
    any_marker = F.coalesce(text, F.lit("")).rlike("|".join("\\[\\Q" + m + "\\E\\]" for m in markers))
    headers = header_sections(text)
    return F.when(any_marker, by_marker).when(F.exists(F.map_keys(headers), lambda k: k != ""), headers).otherwise(F.create_map(F.lit(markers[0]), F.coalesce(text, F.lit(""))))


def context_windows(text: Column, words: Sequence[str], before: int = 30, after: int = 100, most: int = 5, longer_than: int = 10) -> Column:
    """For each word found, in list order, the text around its first place if it is long enough; at most `most`."""
    raw = F.coalesce(text, F.lit(""))
    at = let(lower(text), lambda low: F.filter(F.transform(F.array(*map(F.lit, words)), lambda w: F.instr(low, w)), lambda p: p > 0))
    cut = F.transform(at, lambda p: F.trim(F.substr(raw, F.greatest(F.lit(1), p - before), F.least(p - 1, F.lit(before)) + after)))
    return F.slice(F.filter(cut, lambda c: F.length(c) > longer_than), 1, most)


def listed_keywords(text: Column, words: Sequence[str], most: int = 8) -> Column:
    return F.slice(found_words(text, words), 1, most)


def opening_words(text: Column, n: int = 8) -> Column:
    """The first n words but a leading one of letters, which may be a name; a word alone stays."""
    words = F.filter(F.split(lower(text), r"\s+"), lambda w: w != "")
    return F.regexp_replace(F.array_join(F.slice(words, 1, n), " "), r"^[a-zăâîșț]+\s+", "")


def friction(text: Column, markers: Sequence[str]) -> Column:
    """Markers found for each hundred words."""
    return F.size(found_words(text, markers)) / F.greatest(F.size(tokens(text)) * 0.01, F.lit(1.0))


def anchor_hits(text: Column, anchors: Column) -> Column:
    return let(lower(text), lambda low: F.size(F.filter(F.coalesce(anchors, F.array().cast("array<string>")), lambda a: F.contains(low, F.lower(a)))))


# Words that tell the language, and words that follow a name in that of an institution.
COMMON_WORDS = ["sunt", "și", "pentru", "din", "cu", "care", "mai", "să", "mă", "te", "se", "în", "la", "pe", "o", "un"]
INSTITUTIONS = ["SRL", "SA", "Institut", "Spital", "Școală", "Liceul", "Universitate"]


def institution_names(text: Column) -> Column:
    """How often a capitalised word stands before the word for an institution."""
    return count_matches(text, r"(?<![\p{L}\p{N}_])[A-Z][a-z]+\s+(?:" + "|".join(INSTITUTIONS) + r")(?![\p{L}\p{N}_])")


def narrative_checks(text: Column, name: Column, least: int = 50, most: int = 4000) -> Column:
    """Struct of booleans: length band, at least three marked letters, name mentioned, Romanian, institutions named."""
    raw = F.coalesce(text, F.lit(""))
    marks = count_matches(lower(text), "[ăâîșț]")
    stop = count_matches(lower(text), r"(?<![\p{L}\p{N}_])(?:" + "|".join(COMMON_WORDS) + r")(?![\p{L}\p{N}_])")
    return F.struct(
        F.length(raw).between(least, most).alias("length_ok"),
        (marks >= 3).alias("marks_ok"),
        F.contains(lower(text), lower(F.split_part(F.coalesce(name, F.lit("")), F.lit(" "), F.lit(1)))).alias("name_ok"),
        ((marks >= 2) | (stop >= 3)).alias("romanian"),
        (institution_names(raw) > 0).alias("personal_data"),
    )


def kinds_found(text: Column, words: Sequence[str]) -> Column:
    """How many of the words stand in the text as whole words."""
    low = lower(text)
    return sum((low.rlike(r"(?<![\p{L}\p{N}_])\Q" + w + r"\E(?![\p{L}\p{N}_])").cast("int") for w in words), F.lit(0))


def prompt(template: str, values: Mapping[str, Column]) -> Column:
    """The template with {key} replaced by columns."""
    out = F.lit(template)
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out
