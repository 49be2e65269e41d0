"""Scalar derivations: bins, trait adjustments, scores, ladders, freshness, distances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Age bins, education and occupation effects on traits, least ages.
AGE_EDGES, AGE_LABELS = (15, 25, 35, 45, 55, 65), ("0-14", "15-24", "25-34", "35-44", "45-54", "55-64", "65+")
ADULT_EDGES, ADULT_LABELS = (25, 35, 45, 55, 65), ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
EDUCATION_EFFECTS = {"Gimnazial": (-5, 0), "Liceal": (0, 0), "Profesional/Tehnic": (-2, 2), "Postliceal": (3, 3), "Superior (Licență/Master)": (8, 5), "Doctorat": (12, 8)}
OCCUPATION_EFFECTS = [
    (["artist", "designer", "scriitor", "muzician", "creator"], {"openness": 10, "extraversion": 3}),
    (["contabil", "medic", "inginer", "avocat", "judecător", "ofițer"], {"conscientiousness": 8, "extraversion": -2}),
    (["vânzări", "marketing", "profesor", "manager", "prezentator", "actor"], {"extraversion": 10, "openness": 3}),
    (["asistent", "îngrijitor", "profesor", "consilier", "psiholog", "asistent social"], {"agreeableness": 8, "neuroticism": -3}),
    (["polițist", "pompier", "medic urgent", "pilot", "jurnalist"], {"neuroticism": 5, "conscientiousness": 5}),
]
TRAITS = ("openness", "conscientiousness", "extraversion", "agreeableness", "neuroticism")
LEAST_AGES = {"Primar": 6, "Gimnazial": 10, "Liceal": 14, "Profesional/Tehnic": 14, "Superior (Licență/Master)": 18, "Doctorat": 25}


def bucketize(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the first edge above value, the last label beyond all; null for null."""
    out = F.when(value.isNotNull(), F.lit(labels[len(edges)]))
    for edge, label in reversed(list(zip(edges, labels, strict=False))):
        out = F.when(value < edge, F.lit(label)).otherwise(out)
    return out


def age_group(age: Column) -> Column:
    return bucketize(age, AGE_EDGES, AGE_LABELS)


def adult_age_group(age: Column) -> Column:
    return bucketize(age, ADULT_EDGES, ADULT_LABELS)


def fixed_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Number of the equal-width bin; the last one is closed; null outside."""
    width = (high - low) / bins
    return F.when(value.between(low, high), F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int"))


def clamp(value: Column, low: float = 0, high: float = 100) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def adjusted_traits(base: Mapping[str, Column], age: Column, sex: Column, education: Column, occupation: Column) -> dict[str, Column]:
    """Base scores moved by age (truncated towards zero), sex, education and occupation, then clamped."""
    out = dict(base)
    years, low = age - 30, F.lower(F.coalesce(occupation, F.lit("")))
    for trait, slope in (("conscientiousness", 0.5), ("neuroticism", -0.3), ("agreeableness", 0.2)):
        out[trait] = out[trait] + (years * slope).cast("int")
    for trait, more in (("agreeableness", 3), ("neuroticism", 2)):
        out[trait] = out[trait] + F.when(sex == "Feminin", more).otherwise(0)
    for i, trait in enumerate(("openness", "conscientiousness")):
        effects = F.create_map(*[x for k, v in EDUCATION_EFFECTS.items() for x in (F.lit(k), F.lit(v[i]))])
        out[trait] = out[trait] + F.coalesce(F.try_element_at(effects, education), F.lit(0))
    for words, effects in OCCUPATION_EFFECTS:
        # as a function over the words, the projection is compiled in parts: one method for all traits is too long for the JIT
        hit = F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
        for trait, more in effects.items():
            out[trait] = out[trait] + F.when(hit, more).otherwise(0)
    return {t: clamp(c).cast("int") for t, c in out.items()}


def t_score(raw: Column) -> Column:
    """50 + 10 (raw - 50) / 15, rounded half to even, within 0..100."""
    return clamp(F.bround(50 + 10 * (raw - 50) / 15, 0)).cast("int")


def t_label(score: Column) -> Column:
    return F.when(score >= 60, "high").when(score >= 40, "average").otherwise("low")


def trait_struct(raw: Column) -> Column:
    score = t_score(raw)
    return F.struct(score.alias("t_score"), t_label(score).alias("label"), raw.cast("int").alias("score_0_100"))


def trait_summary(traits: Mapping[str, Column], high: int = 70, low: int = 30) -> Column:
    parts = [F.when(c >= high, F.lit(f"high {t}")).when(c <= low, F.lit(f"low {t}")) for t, c in traits.items()]
    return F.array_join(F.array_compact(F.array(*parts)), ", ")


def ladder(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The name of the first step whose bound value is above."""
    out = F.lit(otherwise)
    for bound, name in reversed(steps):
        out = F.when(value > bound, F.lit(name)).otherwise(out)
    return out


# Names by how far a sum of scores is above, and chances of dissent.
RISK = [(20, "high"), (0, "moderate"), (-20, "low")]
SOCIAL = [(70, "gregarious"), (50, "outgoing"), (30, "selective")]
NOVELTY = [(80, "explorer"), (40, "curious"), (0, "balanced")]
DISSENT_BASE, DISSENT_DISAGREEABLE, DISSENT_OUTGOING, DISSENT_LEAST, DISSENT_MOST = 0.05, 0.35, 0.10, 0.02, 0.60


def behaviour(t: Mapping[str, Column]) -> Column:
    """What five trait scores say of risk, decisions, conflict, company, novelty, dissent, complaints and plans."""
    o, c, e, a, n = (t[k] for k in TRAITS)
    decision = F.when((c > 65) & (o < 45), "deliberative").when((o > 65) & (c < 50), "intuitive").when((c > 65) & (o > 65), "balanced").when(e > 65, "consultative").otherwise("pragmatic")
    conflict = F.when((a > 65) & (n < 45), "accommodating").when((a < 40) & (e > 60), "competing").when((o > 60) & (a > 50), "collaborating").when(n > 60, "avoiding").otherwise("compromising")
    complaint = F.when((n > 65) & (a < 45), "high").when((n > 55) | (a < 40), "moderate").when(a > 65, "low").otherwise("rare")
    planning = F.when(c > 70, "long_term").when(c > 55, "medium_term").when(o > 70, "visionary").otherwise("short_term")
    dissent = DISSENT_BASE + DISSENT_DISAGREEABLE * (1 - a / 100) + DISSENT_OUTGOING * e / 100
    return F.struct(
        ladder(o - n, RISK, "very_low").alias("risk_tolerance"),
        decision.alias("decision_style"),
        conflict.alias("conflict_style"),
        ladder(e, SOCIAL, "reserved").alias("social_pattern"),
        ladder(o + e - c, NOVELTY, "traditional").alias("novelty_seeking"),
        F.least(F.lit(DISSENT_MOST), F.greatest(F.lit(DISSENT_LEAST), dissent)).alias("will_say_no_probability"),
        complaint.alias("complaint_likelihood"),
        planning.alias("planning_horizon"),
    )


# Cues of conduct by trait scores, each with the least score it holds from, and those below all.
CUES = {
    "planning_horizon": ("conscientiousness", [(65, "planifică cu săptămâni/luni în avans, liste și reminder-e"), (45, "planifică câteva zile înainte, dar adaptabil")], "decide spontan, preferă flexibilitate"),
    "routine_tolerance": ("conscientiousness", [(65, "rutină strictă, aceleași ore pentru masă/somn"), (45, "rutină generală cu excepții ocazionale")], "fără rutină fixă, variază de la zi la zi"),
    "social_initiation": ("extraversion", [(65, "contactează primul, propune ieșiri, inițiază conversații"), (45, "răspunde invitațiilor, mai rar inițiază")], "așteaptă să fie invitat, preferă să fie abordat"),
    "social_energy": ("extraversion", [(70, "câștigă energie din interacțiuni, petrece mult timp cu alții"), (50, "echilibrat, socializează dar are nevoie și de timp singur"), (30, "socializare în doze mici, apoi are nevoie de liniște")], "interacțiunile sociale îl/o obosesc, preferă solitudinea"),
}
CONFLICT_CUES = ["caută compromis, evită confruntarea directă", "spune direct ce gândește, fără ocolișuri", "retrage-se din conflict, ruminează după", "negociază pragmatic, dă și ia"]
NOVELTY_CUES = ([(80, "încearcă constant lucruri noi, se plictisește rapid de rutină"), (40, "deschis la noutate, dar cu măsură"), (0, "echilibrat între vechi și nou")], "preferă ce-i familiar, schimbare doar când e necesar")
STRESS_CUES = ([(60, ["insomnie ocazională", "ruminație", "întreabă pe alții dacă totul e ok"]), (40, ["se plânge de oboseală", "caută activități relaxante"])], ["păstrează calm aparent", "rezolvă pas cu pas"], "micromanagement când e stresat")
DECISION_CUES = {"conscientiousness": ("cântărește pro/contra", "decide intuitiv"), "openness": ("întreabă părerea altora", "se bazează pe experiență proprie")}


def cues(t: Mapping[str, Column]) -> Column:
    """Eight cues of conduct of five trait scores (null: 50), two of them arrays of at most three and of two."""
    t = {k: F.coalesce(t[k], F.lit(50)) for k in TRAITS}
    o, c, e, a, n = (t[k] for k in TRAITS)

    def step(score: Column, steps, other) -> Column:
        make = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
        out = make(other)
        for least, value in reversed(steps):
            out = F.when(score >= least, make(value)).otherwise(out)
        return out

    conflict = F.when((a >= 65) & (n <= 50), CONFLICT_CUES[0]).when((a <= 40) & (e >= 60), CONFLICT_CUES[1]).when(n >= 60, CONFLICT_CUES[2]).otherwise(CONFLICT_CUES[3])
    stress = F.concat(step(n, STRESS_CUES[0], STRESS_CUES[1]), F.when((c >= 60) & (n >= 50), F.array(F.lit(STRESS_CUES[2]))).otherwise(F.array().cast("array<string>")))
    named = {k: step(t[trait], steps, other) for k, (trait, steps, other) in CUES.items()}
    decisions = F.array(*[F.when(t[k] >= 60, yes).otherwise(no) for k, (yes, no) in DECISION_CUES.items()])
    return F.struct(
        *[named[k].alias(k) for k in ("planning_horizon", "routine_tolerance", "social_initiation")], conflict.alias("conflict_style"),
        step(o + e - c, *NOVELTY_CUES).alias("novelty_budget"), F.slice(stress, 1, 3).alias("stress_signals"), decisions.alias("decision_cues"), named["social_energy"].alias("social_energy"),
    )


def traits_beyond(traits: Mapping[str, Column], threshold: int, above: bool) -> Column:
    """Names of the traits at or beyond the threshold."""
    return F.array_compact(F.array(*[F.when(c >= threshold if above else c <= threshold, F.lit(t)) for t, c in traits.items()]))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of equal length."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def within(a: Column, b: Column, tolerance: float) -> Column:
    return F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= tolerance), lambda ok: ok)


def row_signature(*columns: str) -> Column:
    """SHA-256 over the JSON of the columns in order of their names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def least_age(education: Column, ages: Mapping[str, int] = LEAST_AGES) -> Column:
    return F.try_element_at(F.create_map(*[x for k, v in ages.items() for x in (F.lit(k), F.lit(v))]), education)


def age_days(ts: Column, now: Column) -> Column:
    """Whole days of 24 hours from ts to now; null, an age without bound, where ts is missing."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(ts)) / 86400).cast("int")


def freshness(days: Column) -> Column:
    """critical over 60 days, stale over 30 or without a time, aging over 7, else fresh."""
    return F.when(days.isNull(), "stale").when(days > 60, "critical").when(days > 30, "stale").when(days > 7, "aging").otherwise("fresh")


# Days after which a profile is told.
ALERT_DAYS = {"ANALYSIS_ONLY": 60, "NARRATIVE_REQUIRED": 30, "HIGH_STAKES": 7}


def stale_for(days: Column, profile: str) -> Column:
    """Whether the age passes what the profile allows; a missing time does."""
    return F.coalesce(days > ALERT_DAYS[profile], F.lit(True))
