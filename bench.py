"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed, with all columns of all rows computed.
"""

import json
import os
import time

from strataloom.queries import QUERIES
from strataloom.session import local_session

HEADLINE = (
    "weighted_choice weighted_choice_large cumulative_intervals harmonize_pool any_column_filter natural_nullsafe_join "
    "anti_residual payer_as_of suffix_join peer_lookup prefix_code_flags strict_sum_distinct relative_freq total_row "
    "survey_mean_all survey_mean_domain percent_rank_exact qq_points stratum_match matched_pairs balance_table "
    "propensity sample_profiles nest_round_trip age_band_recode title_squish_text moment_rescale first_per_group "
    "respondent_input people_matchup people_scores choice_cascade diagnosis_detail comorbidity_detail "
    "drug_means_age_race drug_detail profile_use"
).split()


def run(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, folder)
        times[name] = round(run(spark, name, folder), 3)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "comorbidity_rows_per_sec": round(events / times["comorbidity_detail"]),
    }))


if __name__ == "__main__":
    main()
