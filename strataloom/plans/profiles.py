"""Profile sections for many people at once, as flat tables and as one document per person.

Each section is a flat table keyed by the person; there is no loop over people. Documents hold the
sections as arrays of bounded length, so a person with very many rows is no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import draw32
from ..functions.text import counted, dollars, possessive, pronouns, wrap
from ..operators.aggregates import count_or_zero
from ..operators.columns import relocate, total_row
from ..operators.reshape import parts
from ..operators.sampling import sample_ids
from ..session import materialize

# Texts of the sections that the output must carry.
IMAGE_FOLDER = "./etc/faces/"
EVERYBODY = "...all US residents age 18 and up"
SCORE_TITLE = "Elixhauser Risk Score (total sum of comorbidity contributions)"
# Sentences on the number of rows: none, one, many, and what stands before a number.
CONDITION_TEXT = (" did not receive a diagnosis for any medical conditions in 2021.",
                  "medical condition in 2021.", "medical conditions in 2021.", " received a diagnosis for ")
DRUG_TEXT = (" did not take any prescribed drugs in 2021.", "prescribed drug in 2021.", "prescribed drugs in 2021.", " took ")
COMORBIDITY_TEXT = (" did not receive a diagnosis in 2021 that maps to any Elixhauser Comorbidity categories.",
                    "Elixhauser Comorbidity category.", "Elixhauser Comorbidity categories.",
                    " received a diagnosis in 2021 for ")
# Display names of the sections.
CONDITION_LABELS = {
    "ICD10CM_Pretty": "ICD-10-CM Diagnosis Code",
    "ICD10_DSC": "Specific Diagnosis",
    "CCSR_DSC": "Clinical Diagnosis Category (CCSR)",
    "CHRONIC_IND": "Chronic or Acute Condition? (CCIR)",
    "Age_Diag": "Age when first diagnosed",
}
DRUG_LABELS = {
    "RXNAME": "Drug Name",
    "yrs_on_rx": "Length of time taking the drug",
    "count_unique": "Number of purchases in 2021",
    "cost_oop": "Out-of-pocket cost",
    "cost_plan": "Cost to drug plan",
    "cost_tot": "Total cost",
}


def sampled_people(persons: DataFrame, n: int, seed: int | str) -> DataFrame:
    """Person rows of up to n sampled ids, numbered."""
    return sample_ids(persons, n, "Synthea_ID", "Synthea_ID", seed).join(persons, "Synthea_ID")


def header(persons: DataFrame, image_folder: str = IMAGE_FOLDER) -> DataFrame:
    objective, owning = pronouns("GENDER")
    return persons.select(
        "Synthea_ID", "MEPS_ID",
        F.concat_ws(" ", "PREFIX", "FIRST", "LAST").alias("name"),
        possessive("FIRST").alias("possessive_name"), objective.alias("obj_pronoun"), owning.alias("pos_pronoun"),
        F.concat(F.lit(image_folder), F.col("filename")).alias("image"),
        F.floor("AGELAST").cast("int").alias("age"), "GENDER", "RACETHX", "BIRTHDATE", "MARITAL_STATUS",
        F.concat_ws(", ", "CITY", "STATE").alias("location"),
        F.concat(F.col("PRIMARY_PAYER"), F.lit(" ("), F.col("PRIMARY_PAYER_ORG"), F.lit(")")).alias("health_plan"),
    )


def _of(persons: DataFrame, rows: DataFrame, person: str) -> DataFrame:
    """Rows of the chosen people only."""
    ids = persons.select(F.col("MEPS_ID").alias(person)).distinct()
    return rows.join(ids, person, "left_semi")


def _counted_text(n: str, none: str, one: str, many: str, lead: str) -> Column:
    some = F.concat(F.col("FIRST"), F.lit(lead), F.col(n).cast("string"), F.lit(" unique "))
    return counted(n, F.concat(F.col("FIRST"), F.lit(none)), F.concat(some, F.lit(one)), F.concat(some, F.lit(many)))


def _sentence(persons: DataFrame, rows: DataFrame, none: str, one: str, many: str, lead: str) -> DataFrame:
    counts = count_or_zero(persons, _of(persons, rows, "MEPS_ID"), "MEPS_ID", "__n")
    return counts.select("Synthea_ID", F.col("__n").alias("rows"), _counted_text("__n", none, one, many, lead).alias("sentence"))


def condition_rows(persons: DataFrame, detail: DataFrame) -> DataFrame:
    own = _of(persons, detail.withColumnRenamed("DUPERSID", "MEPS_ID"), "MEPS_ID")
    return own.select("MEPS_ID", *[F.col(c).alias(label) for c, label in CONDITION_LABELS.items()])


def condition_sentence(persons: DataFrame, detail: DataFrame) -> DataFrame:
    return _sentence(persons, detail.select(F.col("DUPERSID").alias("MEPS_ID")), *CONDITION_TEXT)


def drug_rows(persons: DataFrame, detail: DataFrame) -> DataFrame:
    """Drugs of each person and a total line per person that has any."""
    own = _of(persons, detail.withColumnRenamed("ID", "MEPS_ID"), "MEPS_ID").drop("MEPS_DATA_YEAR")
    own = relocate(own, "cost_tot", after="cost_plan")
    return total_row(own, "RXNAME", by=["MEPS_ID"]).withColumnsRenamed(DRUG_LABELS)


def drug_money(rows: DataFrame) -> DataFrame:
    """Cost columns as dollar text, for display."""
    return rows.withColumns({DRUG_LABELS[c]: dollars(F.col(f"`{DRUG_LABELS[c]}`"))
                             for c in ("cost_oop", "cost_plan", "cost_tot")})


def drug_sentence(persons: DataFrame, detail: DataFrame) -> DataFrame:
    return _sentence(persons, detail.select(F.col("ID").alias("MEPS_ID")), *DRUG_TEXT)


def peer_comparison(persons: DataFrame, own: DataFrame, own_value: str, means: dict[str, DataFrame],
                    measure: str) -> DataFrame:
    """Own value against three peer means: same age and race, same age and gender, all adults."""
    figures = [measure, f"{measure}_low", f"{measure}_upp"]
    keyed = persons.select(
        "Synthea_ID", "MEPS_ID", "FIRST", "AGE_GRP_9", F.col("GENDER").alias("SEX_DSC"),
        F.col("RACETHX").alias("RACETHX_DSC"),
    )

    def label(*parts) -> Column:
        return wrap(F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 50)

    race = label("...all US residents in the same general age (", F.col("AGE_GRP_9"),
                 ") and race/ethnicity group (", F.col("RACETHX_DSC"), ") as ", F.col("FIRST"))
    gender = label("...all US residents who are the same gender (", F.col("SEX_DSC"), ") and general age (",
                   F.col("AGE_GRP_9"), ") as ", F.col("FIRST"))
    def found(cut: str, keys: dict[str, str]) -> Column:
        """The means of each person's own cut. A table of cuts has a row per pair of categories, so it fits one value."""
        known = means[cut].dropna(subset=list(keys))
        entry = F.struct(F.struct(*[F.col(k).alias(k) for k in keys]), F.struct(*figures))
        table = known.agg(F.map_from_entries(F.collect_list(entry))).scalar()
        return F.when(~F.greatest(*[F.col(c).isNull() for c in keys.values()]),
                      F.element_at(table, F.struct(*[F.col(c).alias(k) for k, c in keys.items()])))

    # The own value comes first; the three cuts are attached to each row in one projection.
    values = _of(persons, own.select(F.col("ID").alias("MEPS_ID"), F.col(own_value).alias("own_value")), "MEPS_ID")
    looked_up = keyed.join(values, "MEPS_ID", "left").withColumns({
        "__race": found("age_race", {"AGE_GRP_9": "AGE_GRP_9", "RACETHX_DSC": "RACETHX_DSC"}),
        "__gender": found("age_gender", {"AGE_GRP_9": "AGE_GRP_9", "SEX_DSC": "SEX_DSC"}),
        "__all": means["all"].select(F.struct(*figures)).scalar(),
    })
    lines = F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(F.lit(place).alias("position"), text.alias("breakout"),
                                              *[F.col(f"{c}.{f}").alias(f) for f in figures]))
        for place, c, text in ((1, "__race", race), (2, "__gender", gender), (3, "__all", F.lit(EVERYBODY)))
    ])
    return looked_up.select("Synthea_ID", "MEPS_ID", "own_value", F.inline(F.array_compact(lines))).select(
        "MEPS_ID", "Synthea_ID", "position", "breakout", *figures, "own_value")


def comorbidity_rows(persons: DataFrame, detail: DataFrame) -> DataFrame:
    """Classes that a person has, with their weights, and the score last."""
    own = _of(persons, detail.withColumnRenamed("DUPERSID", "MEPS_ID"), "MEPS_ID")
    score = F.col("Field_Name") == "score"
    return own.where(score | (F.col("Field_Value") != 0)).select(
        "MEPS_ID", score.cast("int").alias("position"),
        F.when(score, wrap(F.lit(SCORE_TITLE), 40)).otherwise(F.col("Field_DSC_Short")).alias("Elixhauser Comorbidity"),
        F.when(score, F.col("Field_Value")).otherwise(F.col("vw_weights")).alias("Elixhauser Score Contribution"),
    )


def comorbidity_sentence(persons: DataFrame, detail: DataFrame) -> DataFrame:
    held = detail.where("Field_Name <> 'score' AND Field_Value <> 0")
    return _sentence(persons, held.select(F.col("DUPERSID").alias("MEPS_ID")), *COMORBIDITY_TEXT)


PART_ROWS = 1_000  # rows of a section in one row of the documents


def _sections(persons: DataFrame, dx: DataFrame, drugs: DataFrame, comorbidities: DataFrame) -> DataFrame:
    """The rows of the three lists as one table: respondent, section, and the row as a struct in the section's column."""
    def tagged(rows: DataFrame, section: str, *fields: Column) -> DataFrame:
        return rows.select("MEPS_ID", F.lit(section).alias("section"), F.struct(*fields).alias(section))

    drug = drug_rows(persons, drugs)
    score = F.col("position").cast("int")
    return tagged(condition_rows(persons, dx), "conditions", *[F.col(f"`{c}`") for c in CONDITION_LABELS.values()]).unionByName(
        tagged(drug, "drugs", (F.col(f"`{DRUG_LABELS['RXNAME']}`") == "Total").cast("int").alias("position"),
               *[F.col(f"`{c}`") for c in DRUG_LABELS.values()]), allowMissingColumns=True).unionByName(
        tagged(comorbidity_rows(persons, comorbidities), "comorbidities", score.alias("position"),
               F.col("Elixhauser Comorbidity"), F.col("Elixhauser Score Contribution")), allowMissingColumns=True)


def documents(persons: DataFrame, dx: DataFrame, drugs: DataFrame, use: DataFrame, means: dict[str, DataFrame],
              comorbidities: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """The profile of each person as one row: header, sentences, and the sections as sorted arrays of structs.

    The lists travel as one tagged table with one grouping by respondent. A list of more than
    `part_rows` rows goes on in rows of the same person with a higher `part`; header, sentences and
    peer lines stand in part 0. A section without rows is an empty array.
    """
    lists = ("conditions", "drugs", "comorbidities")
    rows = _sections(persons, dx, drugs, comorbidities)
    rows = rows.withColumn("__draw", draw32("profile", *[F.to_json(F.col(c)) for c in lists]))
    cut = parts(rows, ["MEPS_ID", "section"], "__draw", [F.to_json(c) for c in lists], part_rows)
    grouped = materialize(cut.groupBy("MEPS_ID", "part").agg(
        *[F.sort_array(F.collect_list(c)).alias(c) for c in lists],
        F.count("conditions").alias("n_conditions"), F.count_if(F.col("drugs.position") == 0).alias("n_drugs"),
        F.count_if(F.col("comorbidities.position") == 0).alias("n_comorbidities")))
    counts = grouped.groupBy("MEPS_ID").agg(*[F.sum(f"n_{c}").alias(f"n_{c}") for c in lists])
    known = persons.join(counts, "MEPS_ID", "left").na.fill(0, [f"n_{c}" for c in lists])
    texts = known.select("Synthea_ID", *[
        _counted_text(f"n_{c}", *text).alias(f"{c}_text")
        for c, text in zip(lists, (CONDITION_TEXT, DRUG_TEXT, COMORBIDITY_TEXT))], *[f"n_{c}" for c in lists])
    # The three lines of a peer comparison fit one value.
    peers = [peer_comparison(persons, use, own, means, measure).groupBy("Synthea_ID").agg(
        F.sort_array(F.collect_list(F.struct("position", "breakout", measure, f"{measure}_low", f"{measure}_upp", "own_value")))
        .alias(name)) for name, own, measure in (("use", "RXTOTYY", "mean_util"), ("spending", "RXSLFYY", "mean_oop_spend"))]
    first = header(persons).join(texts, "Synthea_ID")
    for table in peers:
        first = first.join(table, "Synthea_ID", "left")
    own = first.columns[2:]
    empty = {c: F.coalesce(F.col(c), F.array().cast(grouped.schema[c].dataType)) for c in lists}
    first = first.join(grouped.where("part = 0").select("MEPS_ID", *lists), "MEPS_ID", "left").select(
        "Synthea_ID", "MEPS_ID", F.lit(0).cast("long").alias("part"), *own, *[x.alias(c) for c, x in empty.items()])
    more = persons.select("Synthea_ID", "MEPS_ID").join(grouped.where("part > 0").select("MEPS_ID", "part", *lists), "MEPS_ID")
    return first.unionByName(more, allowMissingColumns=True)


def sections(persons: DataFrame, dx: DataFrame, drugs: DataFrame, use: DataFrame, means: dict[str, DataFrame],
             comorbidities: DataFrame) -> dict[str, DataFrame]:
    """All sections as flat tables. Sections without rows are simply empty for a person."""
    return {
        "header": header(persons),
        "conditions": condition_rows(persons, dx),
        "conditions_text": condition_sentence(persons, dx),
        "drugs": drug_rows(persons, drugs),
        "drugs_text": drug_sentence(persons, drugs),
        "use": peer_comparison(persons, use, "RXTOTYY", means, "mean_util"),
        "spending": peer_comparison(persons, use, "RXSLFYY", means, "mean_oop_spend"),
        "comorbidities": comorbidity_rows(persons, comorbidities),
        "comorbidities_text": comorbidity_sentence(persons, comorbidities),
    }


def profiles(persons: DataFrame, dx: DataFrame, drugs: DataFrame, use: DataFrame, means: dict[str, DataFrame],
             comorbidities: DataFrame, n: int, seed: int | str, part_rows: int = PART_ROWS) -> DataFrame:
    """`documents` of up to n sampled people, with their numbers `n`."""
    chosen = materialize(sampled_people(persons, n, seed))
    table = documents(chosen, dx, drugs, use, means, comorbidities, part_rows)
    return chosen.select("Synthea_ID", "n").join(table, "Synthea_ID")
