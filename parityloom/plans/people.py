"""A population of records, drawn column by column from target distributions.

Every draw is a function of (seed, id, step), a 64-bit hash. Tables are parameters: marginals,
and conditionals where the caller has them; without one a field follows its
marginal, which is what fitting from an even seed gives.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators.raking import Raked, rake
from ..operators.sampling import draw, draw_given, fast01, gaussian, resample, uniform_item

# Census shares, and lists that occupations and fields are drawn from.
MARGINALS = {
    "region": {"Chisinau": 0.299, "Centru": 0.278, "Nord": 0.253, "Sud": 0.127, "Gagauzia": 0.043},
    "residence_type": {"Urban": 0.464, "Rural": 0.536},
    "sex": {"Feminin": 0.528, "Masculin": 0.472},
    "age_group": {"0-14": 0.166, "15-24": 0.098, "25-34": 0.124, "35-44": 0.154, "45-54": 0.131, "55-64": 0.144, "65+": 0.183},
    "ethnicity": {"Moldovean": 0.772, "Român": 0.079, "Ucrainean": 0.050, "Găgăuz": 0.043, "Rus": 0.030, "Bulgar": 0.016, "Rrom": 0.004, "Altele": 0.006},
    "education_level": {"Fără studii": 0.024, "Primar": 0.092, "Gimnazial": 0.227, "Liceal": 0.128, "Profesional/Tehnic": 0.336, "Superior (Licență/Master)": 0.181, "Doctorat": 0.012},
    "marital_status": {"Necăsătorit": 0.236, "Căsătorit": 0.558, "Divorțat": 0.085, "Văduv": 0.100, "Separat": 0.021},
    "religion": {"Ortodox": 0.9646686786009324, "Baptist": 0.011139687845779643, "Martor al lui Iehova": 0.0070106210590479695, "Penticostal": 0.005354491915804803, "Adventist": 0.0029656562395802867, "Creștină după Evanghelie": 0.0027031561599382744, "Staroveri (Ortodoxă Rusă de rit vechi)": 0.0017215417844484338, "Islam": 0.0013328887539104852, "Catolic": 0.0010984226633564402, "Altă religie": 0.002004854977201235},
    "mother_tongue": {"Română": 0.800, "Rusă": 0.110, "Găgăuză": 0.038, "Ucraineană": 0.029, "Bulgară": 0.015, "Alta": 0.008},
}
AGES = {"15-24": (18, 24), "25-34": (25, 34), "35-44": (35, 44), "45-54": (45, 54), "55-64": (55, 64), "65+": (65, 84)}
FIELDS_OF_STUDY = {"Educație/Pedagogie": 0.20, "Medicină/Sănătate": 0.15, "Economie/Finanțe": 0.15, "Inginerie": 0.14, "Drept": 0.08, "IT/Informatică": 0.10, "Științe Sociale": 0.08, "Agricultură": 0.05, "Arte/Umanistice": 0.05}
YOUNG_EDUCATION = {"Gimnazial": 0.05, "Liceal": 0.25, "Profesional/Tehnic": 0.25, "Superior (Licență/Master)": 0.45}
SCHOOL_EDUCATION = {"Gimnazial": 0.15, "Liceal": 0.45, "Profesional/Tehnic": 0.40}
HIGH_SKILL = ["Profesor", "Medic", "Inginer", "Avocat", "Contabil", "Manager", "Programator", "Farmacist", "Arhitect", "Economist", "Psiholog"]
MEDIUM_SKILL = ["Învățător", "Asistent medical", "Tehnician", "Secretar", "Vânzător", "Șofer", "Bucătar", "Croitoreasă", "Electrician", "Instalator", "Mecanic", "Coafor", "Asistent social"]
LOW_SKILL = ["Muncitor necalificat", "Agricultor", "Personal de curățenie", "Paznic", "Îngrijitor", "Lăcătuș", "Tâmplar", "Zidar", "Ospătar"]
RURAL = ["Agricultor", "Fermier", "Meșteșugar", "Învățător", "Asistent medical", "Comerciant mic", "Preot", "Îngrijitor", "Muncitor agricol"]
CAPITAL = ["Programator", "Analist financiar", "Consultant IT"]
FORMER = ["profesor", "inginer", "medic", "contabil", "muncitor"]
HIGHER = ["Superior (Licență/Master)", "Doctorat"]
EMPLOYMENT = {"employed": 0.427, "unemployed": 0.018, "student": 0.08, "retired": 0.183, "homemaker": 0.06, "other_inactive": 0.232}
FIRST = {"Feminin": ["Ana", "Elena", "Maria", "Natalia", "Olga", "Irina", "Doina", "Tatiana"], "Masculin": ["Ion", "Vasile", "Andrei", "Sergiu", "Mihai", "Nicolae", "Victor", "Alexandru"]}
LAST = ["Rusu", "Ceban", "Munteanu", "Popa", "Ursu", "Moraru", "Cojocaru", "Lungu", "Bostan", "Railean"]


def _occupation(age: Column, education: Column, residence: Column, region: Column, u: Mapping[str, Column]) -> Column:
    """Struct (occupation, sector): students, pensioners, then by residence and education."""
    job = lambda name, sector: F.struct(name.alias("occupation"), (F.lit(sector) if sector is None or isinstance(sector, str) else sector).cast("string").alias("sector"))
    high = education.isin(HIGHER)
    rate = F.when(age == 63, 0.55).when(age == 64, 0.65).otherwise(0.75)
    retired = F.concat(F.lit("Pensionar (fost: "), uniform_item(FORMER, u["pick"]), F.lit(")"))
    trade = F.when(u["sector"] < 0.5, "Industrie").otherwise("Servicii")
    return (
        F.when((age < 22) & education.isin("Liceal", *HIGHER) & (u["first"] < 0.75), job(F.lit("Student"), "Educație"))
        .when((age >= 63) & (u["first"] < rate), job(retired, None))
        .when((region == "Chisinau") & high & (u["capital"] < 0.3), job(uniform_item(CAPITAL, u["pick"]), "Servicii"))
        .when((residence == "Rural") & (u["rural"] < 0.4), job(uniform_item(RURAL, u["pick"]), "Agricultură"))
        .when(residence == "Rural", job(uniform_item(LOW_SKILL + MEDIUM_SKILL[:5], u["pick"]), "Servicii"))
        .when(high, job(uniform_item(HIGH_SKILL, u["pick"]), "Servicii"))
        .when(education == "Profesional/Tehnic", job(uniform_item(MEDIUM_SKILL, u["pick"]), trade))
        .otherwise(job(uniform_item(LOW_SKILL + MEDIUM_SKILL[:8], u["pick"]), "Servicii"))
    )


def population(ids: DataFrame, seed: int = 42, marginals: Mapping[str, Mapping[str, float]] = MARGINALS, conditionals: Mapping[str, tuple[str, DataFrame]] | None = None, ages: Mapping[int, int] | None = None, employment: Mapping[str, Mapping[str, float]] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """A record for each id; all in one projection unless conditionals {field: (given, table)} are joined.

    Columns of ids named in keep follow the record.

    employment, shares of status by age group, holds for those who are neither students nor
    pensioners by occupation; groups it lacks follow the national shares.

    ages, counts by single age, shape the age within its group; without them the
    age is triangular.
    """
    i = F.col("id")
    u = lambda step: fast01(seed, i, step)
    given = dict(conditionals or {})
    adult = {k: v for k, v in marginals["age_group"].items() if k in AGES}
    out = ids.select("id", *keep)
    for f, shares in (("sex", marginals["sex"]), ("age_group", adult), ("region", marginals["region"])):
        out = out.withColumn(f, draw(shares, u(f)))
    for f in ("residence_type", "ethnicity", "mother_tongue", "religion", "marital_status"):
        if f in given:
            on, table = given[f]
            spark = ids.sparkSession
            national = spark.createDataFrame(list(marginals[f].items()), "category string, p double")
            out = draw_given(out, on, table, u(f), f, national).drop("fell_back")
        else:
            out = out.withColumn(f, draw(marginals[f], u(f)))
    # a column of its own, so that it is made once a row; no age leaves its group, which stays as it was drawn
    t = u("age")
    out = out.withColumn("t_", F.sqrt(t / 2) * (t < 0.5).cast("int") + (1 - F.sqrt((1 - t) / 2)) * (t >= 0.5).cast("int"))
    age = F.lit(None).cast("int")
    for name, (low, high) in AGES.items():
        inside = {str(a): n for a, n in (ages or {}).items() if low <= a <= high}
        one = draw(inside, t).cast("int") if inside else F.floor(low + (high + 1 - low) * F.col("t_")).cast("int")
        age = F.when(F.col("age_group") == name, F.least(one, F.lit(high))).otherwise(age)
    out = out.withColumn("age", age)
    shares = {k: v for k, v in marginals["education_level"].items()}
    education = F.when(F.col("age") < 19, draw(SCHOOL_EDUCATION, u("education"))).when(F.col("age") < 27, draw(YOUNG_EDUCATION, u("education"))).otherwise(draw(shares, u("education")))
    out = out.withColumn("education_level", education)
    out = out.withColumn("field_of_study", F.when(F.col("education_level").isin(HIGHER), draw(FIELDS_OF_STUDY, u("field"))))
    steps = {k: u("job" + k) for k in ("first", "pick", "sector", "rural", "capital")}
    out = out.withColumn("job_", _occupation(F.col("age"), F.col("education_level"), F.col("residence_type"), F.col("region"), steps))
    job = F.col("job_.occupation")
    status = F.when(job == "Student", "student").when(job.startswith("Pensionar"), "retired")
    for group, shares in (employment or {}).items():
        status = status.when(F.col("age_group") == group, draw(shares, u("status")))
    status = status.otherwise(draw(EMPLOYMENT, u("status")))
    first = F.when(F.col("sex") == "Feminin", uniform_item(FIRST["Feminin"], u("name"))).otherwise(uniform_item(FIRST["Masculin"], u("name")))
    base = {t: scalar.clamp(gaussian(50, 15, seed, i, t, fast01)).cast("int") for t in scalar.TRAITS}
    traits = scalar.adjusted_traits(base, F.col("age"), F.col("sex"), F.col("education_level"), job)
    return out.select(
        F.concat_ws("-", F.lit(str(seed)), i.cast("string")).alias("uuid"), "id",
        F.concat_ws(" ", first, uniform_item(LAST, u("surname"))).alias("name"),
        "sex", "age", "age_group", "ethnicity", "mother_tongue", "religion", "marital_status", "education_level", "field_of_study",
        job.alias("occupation"), F.col("job_.sector").alias("occupation_sector"), status.alias("employment_status"),
        "region", "residence_type", F.lit("Moldova").alias("country"), *[c.alias(f"ocean_{t}") for t, c in traits.items()], *keep,
    )


def generate(spark: SparkSession, n: int, seed: int = 42, **options) -> DataFrame:
    return population(spark.range(n), seed, **options)


def corrected(spark: SparkSession, n: int, seed: int = 42, oversample: int = 3, fields: tuple[str, ...] = ("sex", "age_group", "residence_type", "ethnicity", "region"), **options) -> tuple[DataFrame, Raked]:
    """n records out of oversample times as many, raked to the marginals and drawn by weight.

    A record drawn twice gets a uuid of its own and keeps its source_id. As a record is a function of its id,
    only ids, raked fields and weights are counted, sorted and drawn, and the rows of Raked hold no more;
    the other columns are made for what is drawn.
    """
    targets = {f: {k: v for k, v in MARGINALS[f].items() if f != "age_group" or k in AGES} for f in fields}
    raked = rake(generate(spark, n * oversample, seed, **options).select("id", *fields), targets)
    whole = raked.rows.select("id", "weight", F.round(F.col("weight") * 1_000_000).cast("long").alias("points"))
    drawn = population(resample(whole, "id", "points", n), seed, keep=("weight", "draw", "source_id"), **options)
    return drawn.withColumn("uuid", F.concat_ws("-", F.lit(str(seed)), "source_id", "draw")), raked
