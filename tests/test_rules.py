"""Hand-computed fixtures for rules that are easy to get wrong."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marshlight.functions import binning, geo, nulls, periods, text
from marshlight.operators import series as S
from marshlight.plans import assemble, formatting, incidence, outliers, population, quality, reporting, reports, seasonality, survey
from marshlight.sources import config

FIXED = "PERIOD int, YEAR int, MONTH int, ADM1_ID string, ADM2_ID string, OU_ID string, ADM1_NAME string, ADM2_NAME string, OU_NAME string"


def routine(spark, rows, cols):
    """rows: (ou, yyyymm, values...)."""
    data = [(p, p // 100, p % 100, "R1", "D1", ou, "Region", "District", f"Unit {ou}", *vals) for ou, p, *vals in rows]
    return spark.createDataFrame(data, FIXED + "".join(f", {c} double" for c in cols))


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_three_sums(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, None), (3, 2.0)], "k int, v double")
    got = {r.k: (r.z, r.p, r.a) for r in df.groupBy("k").agg(
        nulls.sum_zero("v").alias("z"), nulls.sum_poison("v").alias("p"), nulls.sum_any("v").alias("a")).collect()}
    assert got == {1: (1.0, None, 1.0), 2: (0.0, None, None), 3: (2.0, 2.0, 2.0)}


def test_ratio_never_raises(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    assert values(df.select(nulls.ratio("a", "b").alias("r")), "r") == [(None,), (None,), (0.25,)]


def test_imputation_fills_every_gap_but_not_the_ends(spark):
    months = [200001 + i for i in range(6)]
    data = [None, 10.0, None, 13.0, 500.0, 20.0]
    df = routine(spark, [("F1", p, v) for p, v in zip(months, data)], ["CONF"])
    df = df.withColumn("OUT_CONF", F.col("CONF") == 500).fillna(False, ["OUT_CONF"])
    got = dict(values(S.with_imputed(df, ["CONF"], "mean", ["OU_ID"]), "PERIOD", "FILL_CONF"))
    # first row: no full neighbourhood; third: ceil((10 + 13) / 2); fifth: ceil((13 + 20) / 2)
    assert [got[p] for p in months] == [None, 10.0, 12.0, 13.0, 17.0, 20.0]


def test_three_missing_in_a_row_stay_missing(spark):
    months = [200001 + i for i in range(5)]
    df = routine(spark, list(zip(["F1"] * 5, months, [5.0, None, None, None, 7.0])), ["CONF"])
    df = df.withColumn("OUT_CONF", F.lit(False))
    for how in ("mean", "median"):
        got = dict(values(S.with_imputed(df, ["CONF"], how, ["OU_ID"]), "PERIOD", "FILL_CONF"))
        assert [got[p] for p in months] == [5.0, 5.0, None, 7.0, 7.0]


def test_iqr_limits_use_rounded_up_quartiles(spark):
    data = [1.0, 2.0, 3.0, 4.0, 9.0]
    df = routine(spark, [("F1", 200001 + i, v) for i, v in enumerate(data)], ["CONF"])
    flagged = outliers.run(df, ["CONF"], "IQR").detected
    # quartiles 2 and 4, limits -1 and 7
    assert sorted(values(flagged.filter("OUTLIER_DETECTED"), "VALUE")) == [(9.0,)]


def test_constant_series_has_no_outlier(spark):
    df = routine(spark, [("F1", 200001 + i, 4.0) for i in range(8)], ["CONF"])
    for method in ("IQR", "MEAN", "MEDIAN"):
        assert outliers.run(df, ["CONF"], method).detected.filter("OUTLIER_DETECTED").count() == 0


def test_single_value_series(spark):
    df = routine(spark, [("F1", 200001, 4.0)], ["CONF"])
    out = outliers.run(df, ["CONF"], "MEAN")
    assert values(out.detected, "OUTLIER_DETECTED") == [(False,)]
    assert values(out.imputed, "CONF") == [(4.0,)]


def test_removed_keeps_rows_for_staged_and_drops_them_for_quartiles(spark):
    rows = [("F1", 200001 + i, v) for i, v in enumerate([10.0, 11.0, 12.0, 11.0, 10.0, 11.0, 12.0, 900.0])]
    df = routine(spark, rows, ["CONF"])
    assert outliers.run(df, ["CONF"], "IQR").removed.count() == 7
    staged = outliers.run_staged(df, ["CONF"])
    assert staged.removed.count() == 8
    assert dict(values(staged.removed, "PERIOD", "CONF"))[200008] is None


def test_staged_second_pass_sees_the_rest_only(spark):
    # 900 goes first; without it the MAD is smaller and 60 goes in the second pass
    data = [10.0, 11.0, 12.0, 10.0, 11.0, 12.0, 11.0, 22.0, 900.0]
    df = routine(spark, [("F1", 200001 + i, v) for i, v in enumerate(data)], ["CONF"])
    got = values(outliers.staged_mad(outliers.facility_months(df, ["CONF"]), ["CONF"]), "CONF", "FIRST_CONF", "OUT_CONF")
    assert {v: (a, b) for v, a, b in got}[900.0] == (True, True)
    assert {v: (a, b) for v, a, b in got}[22.0] == (False, True)


def test_duplicate_months_are_reduced(spark):
    df = routine(spark, [("F1", 200001, 5.0), ("F1", 200001, 3.0), ("F1", 200002, 4.0)], ["CONF"])
    assert sorted(values(outliers.facility_months(df, ["CONF"]), "PERIOD", "CONF")) == [(200001, 3.0), (200002, 4.0)]


PATH = ["TEST", "CONF", "PRES"]


def pathway(spark, special, deviation=3):
    base = [("F1", 200001 + i if i < 12 else 200101 + i - 12, 100.0 + i % 3, 20.0 + i % 3, 60.0 + i % 3) for i in range(19)]
    df = routine(spark, base + [("F1", 200108, *special)], PATH)
    return outliers.run_pathway(df, PATH, deviation), df


def test_stockout_clears_presumed_cases(spark):
    # tests below their mean, presumed cases high but under the usual range of tests
    out, _ = pathway(spark, (30.0, 20.0, 90.0))
    got = {r.INDICATOR: r.OUTLIER_DETECTED for r in out.detected.filter("PERIOD = 200108").collect()}
    assert got == {"TEST": False, "CONF": False, "PRES": False}


def test_presumed_cases_stay_flagged_without_low_testing(spark):
    out, _ = pathway(spark, (102.0, 20.0, 90.0))
    got = {r.INDICATOR: r.OUTLIER_DETECTED for r in out.detected.filter("PERIOD = 200108").collect()}
    assert got["PRES"] is True


def test_epidemic_is_recorded_but_keeps_the_flag(spark):
    _, df = pathway(spark, (900.0, 300.0, 61.0))
    flags = outliers.pathway_exceptions(outliers.pathway_flags(outliers.full_grid(df, PATH), PATH, 3), PATH, 3)
    row = flags.filter("PERIOD = 200108").first()
    assert row.POSSIBLE_EPID is True and row.OUT_CONF is True and row.OUT_TEST is True


def test_imputation_goes_back_when_it_breaks_the_order(spark):
    # CONF is not flagged, TEST is; imputing TEST by about 101 would put it below CONF
    base = [("F1", 200001 + i, 100.0 + i % 3, 150.0 + i % 60, 60.0) for i in range(11)]
    df = routine(spark, base + [("F1", 200012, 900.0, 160.0, 60.0)], PATH)
    got = outliers.run_pathway(df, PATH, 3).imputed.filter("PERIOD = 200012").first()
    assert (got.TEST, got.CONF) == (900.0, 160.0)


def test_trimming_keeps_ranks_above_ten_up_to_ninety_percent(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [0, *range(1, 11)]], "k string, v double")
    row = S.trimmed_stats(df, ["k"], ["v"]).first()
    # ranks 2..9 of the ten positive values
    assert row.MEAN_80_v == math.ceil(sum(range(2, 10)) / 8)


# --- reporting --------------------------------------------------------------------------------------

REPORT = "PERIOD int, YEAR int, MONTH int, OU_ID string, ADM2_ID string, PRODUCT_UID string, ACTUAL_REPORTS double, EXPECTED_REPORTS double"


def test_agreeing_products_count_twice(spark):
    rows = [(200001, 2000, 1, "F1", "D1", "a", 1.0, 1.0), (200001, 2000, 1, "F1", "D1", "b", 1.0, 1.0),
            (200002, 2000, 2, "F1", "D1", "a", 0.0, 1.0), (200002, 2000, 2, "F1", "D1", "b", 1.0, 1.0),
            (200001, 2000, 1, "F2", "D1", "a", 0.0, 1.0)]
    got = values(reporting.deduplicate_reports(spark.createDataFrame(rows, REPORT)), "PERIOD", "OU_ID", "PRODUCT_UID")
    assert sorted(got) == [(200001, "F1", "a"), (200001, "F1", "b"), (200001, "F2", "a"), (200002, "F1", "b")]


def test_no_deduplication_when_a_doubled_row_is_not_zero_or_one(spark):
    rows = [(200001, 2000, 1, "F1", "D1", "a", 2.0, 1.0), (200001, 2000, 1, "F1", "D1", "b", 1.0, 1.0)]
    assert reporting.deduplicate_reports(spark.createDataFrame(rows, REPORT)).count() == 2


def test_facility_without_cases_has_no_weight_but_counts(spark):
    df = routine(spark, [("F1", 200001, 10.0), ("F1", 200002, None), ("F2", 200001, 0.0), ("F3", 200001, 30.0)], ["CONF"])
    got = {r.OU_ID: r.WEIGHT for r in reporting.facility_weights(df, ["CONF"]).collect()}
    assert got == {"F1": pytest.approx(10 / 40 * 3), "F2": None, "F3": pytest.approx(30 / 40 * 3)}
    # weights of active facilities add up to the number of facilities
    assert sum(w for w in got.values() if w) == pytest.approx(3)


def test_open_flag_by_dates_and_name(spark):
    df = spark.createDataFrame(
        [("R", "r", "D", "d", "A", "OK", "1999-05-10", None), ("R", "r", "D", "d", "B", "CENTRE FERME", "1999-01-01", None),
         ("R", "r", "D", "d", "C", "NO DATE", None, None), ("R", "r", "D", "d", "E", "CLOSED", "1999-01-01", "2000-02-01")],
        "ADM1_ID string, ADM1_NAME string, ADM2_ID string, ADM2_NAME string, OU_ID string, OU_NAME string, OPENING_DATE string, CLOSED_DATE string")
    facts = routine(spark, [("A", 200001, 0.0), ("A", 200003, None), ("B", 200002, -1.0)], ["CONF"])
    got = {(r.OU_ID, r.PERIOD): (r.OPEN, r.ACTIVE_THIS_PERIOD, r.ACTIVE_THIS_YEAR)
           for r in reporting.facility_months(df, facts, ["CONF"]).collect()}
    assert len(got) == 12
    assert got["A", 200001] == (1, 1, 1) and got["A", 200003] == (1, 0, 1)
    assert got["B", 200002] == (0, 0, 0)  # closed by name, negative value is no activity
    assert got["C", 200001] == (0, 0, 0)
    assert got["E", 200001] == (1, 0, 0) and got["E", 200002] == (0, 0, 0)


# --- incidence --------------------------------------------------------------------------------------


def test_positivity_is_one_without_tests(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 10.0), (5.0, None)], "CONF double, TEST double")
    assert values(df.select(incidence.positivity().alias("t")), "t") == [(1.0,), (0.5,), (1.0,)]


def test_one_month_without_rate_makes_the_year_unknown(spark):
    df = routine(spark, [("F1", 200001, 10.0, 20.0, 30.0, 4.0), ("F1", 200002, 10.0, 20.0, 30.0, 4.0)], ["CONF", "TEST", "SUSP", "PRES"])
    rate = spark.createDataFrame([("D1", 2000, 1, 0.5)], "ADM2_ID string, YEAR int, MONTH int, REPORTING_RATE double")
    care = spark.createDataFrame([("R1", 0.5)], "ADM1_ID string, CARESEEKING double")
    pop = spark.createDataFrame([("D1", 2000, 1000.0)], "ADM2_ID string, YEAR int, POPULATION double")
    row = incidence.incidence(df, rate, pop, "PRES", incidence.care_seeking(care, "CARESEEKING")).first()
    assert row.CONF == 20 and row.N1 == 24 and row.N2 is None
    assert row.N3 == pytest.approx(12 / 0.5 / 0.5)
    assert row.INCIDENCE_CRUDE == pytest.approx(20.0) and row.INCIDENCE_ADJ_REPORTING is None


def test_care_seeking_in_percent_is_kept(spark):
    df = spark.createDataFrame([("R1", "40"), ("R2", "0.5"), ("R1", "30")], "ADM1_ID string, p string")
    assert dict(values(incidence.care_seeking(df, "p"), "ADM1_ID", "CARESEEKING_PCT")) == {"R1": 30.0, "R2": 0.5}


def test_missing_group_column_fails(spark):
    df = spark.createDataFrame([("D1", 2000, 5.0)], "ADM2_ID string, YEAR int, POPULATION double")
    with pytest.raises(ValueError, match="POP_UNDER_5"):
        incidence.choose_population(df, "UNDER_5")
    assert incidence.choose_population(df, "UNDER_5", fall_back=True) is df


# --- population -------------------------------------------------------------------------------------


def test_projection_rounds_every_year(spark):
    df = spark.createDataFrame([("D1", 2000, 105.0), ("D1", 1999, 1.0)], "ADM2_ID string, YEAR int, POPULATION double")
    got = dict(values(population.project(df, 0.03, back=2, forward=3), "YEAR", "POPULATION"))
    up, down = [105.0], [105.0]
    for _ in range(3):
        up.append(float(round(up[-1] * 1.03)))
    for _ in range(2):
        down.append(float(round(down[-1] / 1.03)))
    assert [got[2000 + i] for i in range(4)] == up and [got[2000 - i] for i in range(3)] == down


def test_scaling_multiplies_by_total_over_reference(spark):
    df = spark.createDataFrame([("D1", 2000, 100.0), ("D2", 2000, 300.0)], "ADM2_ID string, YEAR int, POPULATION double")
    assert dict(values(population.scale_to_reference(df, 200), "ADM2_ID", "POPULATION")) == {"D1": 200, "D2": 600}


def test_absent_reference_year_falls_back_to_latest(spark):
    df = spark.createDataFrame([("D1", 2000, 1.0), ("D1", 2003, 7.0)], "ADM2_ID string, YEAR int, POPULATION double")
    for year in (1990, None):
        assert values(population.project(df, 0.1, back=0, forward=0, year=year), "YEAR", "POPULATION") == [(2003, 7.0)]


def test_blank_share_column_is_skipped(spark):
    df = spark.createDataFrame([("D1", 2000, 100.0, 9.0)], "ADM2_ID string, YEAR int, POPULATION double, POP_A double")
    shares = spark.createDataFrame([("D1", None, "0.25")], "ADM2_ID string, POP_A string, POP_B string")
    row = population.add_district_groups(df, shares).first()
    assert (row.POP_A, row.POP_B) == (9.0, 25.0) or (row.POP_A, row.POP_B) == (9.0, 25)


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-0.5,)], "v double")
    assert values(df.select(nulls.round_even("v").alias("r")), "r") == [(2.0,), (4.0,), (0.0,)]


# --- scalars ----------------------------------------------------------------------------------------


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_names(spark):
    assert one(spark, text.normalise_name(F.lit("  Hôpital-de l'Été / N°2 "))) == "HOPITAL DE L ETE N 2"
    assert one(spark, text.short_admin_name(F.lit("kl Kwilu Nord Province"))) == "Kwilu Nord"
    assert one(spark, text.short_admin_name(F.lit("Kwilu Province"))) == ""
    assert one(spark, text.facility_type(F.lit("csi  de Zinder"))) == "CSI (centre de santé intégré)"
    assert one(spark, text.facility_type(F.lit("CSIX"))) == "Autre"


def test_weeks(spark):
    assert one(spark, periods.iso_week(F.lit("2021-01-01"))) == "2020W53"
    # the week from Thursday 31 December 2020 has its fourth day in 2021
    assert one(spark, periods.epi_week(F.lit("2020-12-30"))) == "2020ThuW52"
    assert one(spark, periods.epi_week(F.lit("2020-12-31"))) == "2021ThuW01"
    assert one(spark, periods.epi_week(F.lit("2021-01-07"))) == "2021ThuW02"


def test_point_text(spark):
    good = one(spark, geo.parse_point(F.lit('{"type":"Point","coordinates":["1.5", -2]}')))
    assert (good.lon, good.lat, good.parse_ok) == (1.5, -2.0, True)
    for bad in ("", "{", '{"coordinates":[1]}', None):
        got = one(spark, geo.parse_point(F.lit(bad).cast("string")))
        assert (got.lon, got.lat, got.parse_ok) == (None, None, False)


def test_decimal_moves(spark):
    assert one(spark, geo.move_decimal(F.lit(-12345.0), 2)) == -12.345
    assert one(spark, geo.move_decimal(F.lit(7.0), 1)) is None
    assert one(spark, geo.move_decimal(F.lit(0.0123), 1)) == pytest.approx(0.0123)


def test_bins_are_null_outside(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 5.0, 10.0, 11.0)], "v double")
    got = [r[0] for r in df.select(binning.cut_half_open("v", [0, 5, 10])).collect()]
    assert got == [None, "< 5%", ">= 5%", ">= 5%", None]
    assert binning.thousands_labels([1000, 2500, 1000000]) == ["< 1k", "1 - 2.5k", "2.5 - 1'000k", "> 1'000k"]


def test_rounded_breaks():
    assert reports.rounded_breaks([0.0, 1234.0, 56789.0]) == [1000, 57000]


# --- quality, survey, assembly ----------------------------------------------------------------------


def test_quality_accepts_text_and_blanks(spark):
    df = spark.createDataFrame([("D1", 2000, "5", "10"), ("D1", 2000, "-", ""), ("D2", 2000, "3", "0")],
                               "ADM2_ID string, YEAR int, TEST string, SUSP string")
    got = {r.ADM2_ID: (r.TEST, r.testing_rate) for r in quality.quality_of_care(df).collect()}
    assert got == {"D1": (5.0, 0.5), "D2": (3.0, None)}


def test_access_can_exceed_one(spark):
    h = spark.createDataFrame([(1, 4, 3), (2, 2, None)], "HHID int, HV013 int, N1 int")
    p = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "HHID int, HV103 int")
    assert values(survey.net_access(h, p, ["N1"], key=["HHID"]), "HHID", "PCT_ITN_ACCESS") == [(1, 4.0)]


def test_later_dose_implies_earlier(spark):
    df = spark.createDataFrame([(0, 8, 1), (1, None, 0), (None, 0, 8)], "H3 int, H5 int, H7 int")
    assert values(survey.dose_flags(df), "DTP1", "DTP2", "DTP3") == [(1, 1, 1), (1, None, 0), (None, 0, None)]


def test_update_rules(spark):
    from marshlight.operators.joins import update_columns

    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    new = spark.createDataFrame([("a", None), ("b", 3.456)], "k string, v double")
    assert sorted(values(update_columns(old, new, ["k"], ["v"]), "k", "v")) == [("a", 1.0), ("b", 3.456)]
    got = values(update_columns(old, new, ["k"], ["v"], keep_old=False, rounding=2), "k", "v")
    assert sorted(got, key=lambda r: r[0]) == [("a", None), ("b", 3.46)]


def test_missing_inputs_skip_their_layer(spark):
    admin = spark.createDataFrame([("R", "r", "D", "d")], "ADM1_ID string, ADM1_NAME string, ADM2_ID string, ADM2_NAME string")
    row = assemble.assemble(admin, ["POPULATION", "REPORTING_RATE"]).first()
    assert row.POPULATION is None and row.ADM2_ID == "D"


def test_season_labels(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "v int")
    assert [r[0] for r in df.select(assemble.season_label("v")).collect()] == ["not-seasonal", "seasonal", None]


def test_unknown_metadata_variable_fails(spark):
    meta = config.metadata_table(spark, {"A": {"LABEL": "a", "PERIOD": None}})
    bad = spark.createDataFrame([("B", "2000")], "VARIABLE string, PERIOD string")
    with pytest.raises(Exception, match="unknown variable"):
        config.update_metadata(meta, bad).collect()


def test_unmapped_unit_fails(spark):
    from marshlight.operators.joins import remap_units

    units = spark.createDataFrame([("F1", "a"), ("F2", "x")], "OU_ID string, OLD string")
    mapping = spark.createDataFrame([("a", "b")], "OLD string, NEW string")
    with pytest.raises(Exception, match="unit without mapping"):
        remap_units(units, mapping, ["OLD"], ["NEW"]).collect()


def test_indicator_counts_a_category_once(spark):
    raw = spark.createDataFrame([("A", "x", "F1", "200001", "5"), ("A", "y", "F1", "200001", "bad"), ("B", None, "F2", "200001", None)],
                                "DX string, CO string, OU string, PE string, VALUE string")
    mapping = config.indicator_map(spark, {"I": ["A", "A.x"], "J": ["A.y"], "K": ["B"], "E": []})
    pyramid = spark.createDataFrame([("F1", "Zoné"), ("F2", "b")], "OU_ID string, OU_NAME string")
    got = {r.OU_ID: r for r in formatting.format_routine(raw, mapping, ["I", "J", "K", "E"], pyramid).collect()}
    assert (got["F1"].I, got["F1"].J, got["F1"].K, got["F1"].E, got["F1"].OU_NAME) == (5.0, None, None, None, "ZONE")
    assert got["F2"].K is None and got["F2"].MONTH == 1


def test_jackknife_of_one_cluster_is_unknown(spark):
    from marshlight.operators.survey import under_five_mortality

    rows = [(1, 1, 1000000, 1400, 1300, None), (1, 1, 1000000, 1400, 1300, 4)]
    row = under_five_mortality(spark.createDataFrame(rows, "V024 int, V021 int, V005 long, V008 int, B3 int, B7 int")).first()
    assert row.R == pytest.approx(500.0) and row.se is None


def test_care_seeking_that_is_no_number_fails(spark):
    df = spark.createDataFrame([("R1", "30"), ("R2", "a third")], "ADM1_ID string, p string")
    with pytest.raises(Exception, match="not a number: a third"):
        incidence.care_seeking(df, "p").collect()


def test_rain_with_too_few_months_or_too_many_gaps_is_refused(spark):
    months = [(y, m) for y in range(2018, 2022) for m in range(1, 13)]
    full = [("D1", y, m, y * 100 + m, 5.0 if m in (6, 7, 8) else 1.0) for y, m in months]
    schema = "ADM2_ID string, YEAR int, MONTH int, PERIOD int, MEAN double"
    assert seasonality.rain_seasonality(spark.createDataFrame(full, schema)).count() == 1
    for rows in (full[:47], [(*r[:4], None) if k % 4 == 0 else r for k, r in enumerate(full)]):
        with pytest.raises(ValueError, match="not fit for seasonality"):
            seasonality.rain_seasonality(spark.createDataFrame(rows, schema))


def test_best_classes_have_the_least_sum_of_squares():
    rng = np.random.default_rng(2)
    for n in (2, 3, 4):
        values = np.sort(rng.choice(np.arange(200.0), 14, replace=False))
        counts = rng.integers(1, 9, 14).astype(float)

        def cost(ends):
            return sum((counts[a:b] * (values[a:b] - np.average(values[a:b], weights=counts[a:b])) ** 2).sum() for a, b in zip([0, *ends], ends))

        every = [[*c, 14] for c in itertools.combinations(range(1, 14), n - 1)]
        assert cost(reports.best_classes(values, counts, n)) == pytest.approx(min(map(cost, every)))


def test_breaks_of_many_values_few_values_and_none(spark):
    many = spark.range(20_000).select((F.col("id") + F.when(F.col("id") >= 10_000, 50_000).otherwise(0)).cast("double").alias("v"))
    low, middle, high = reports.k_means_breaks(many, "v", 2)
    assert (low, high) == (0.0, 69_999.0) and abs(middle - 34_999.5) < 1
    assert reports.k_means_breaks(many.where("v in (1, 5)"), "v", 4) == [1.0, 3.0, 5.0]
    assert reports.k_means_breaks(many.where("v < 0"), "v", 4) == []
