"""Small literal reference tables (broadcast-size by construction).

Each table is a handful of rows; they are created as DataFrames so that joins
against them stay inside the plan (no 60-branch CASE expressions) and can be
broadcast with a proven size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the published method for comparable results).
# European Standard Population 2013 weights by five-year age band 1..19
# (0-4, 5-9, ..., 85-89, 90+), and the partial-band weights used by the
# age-restricted cuts.  Band numbers are those produced by ``age_band``.
# ---------------------------------------------------------------------------
EPOP_WEIGHTS = {
    "normal": {1: 5000, 2: 5500, 3: 5500, 4: 5500, 5: 6000, 6: 6000, 7: 6500, 8: 7000,
               9: 7000, 10: 7000, 11: 7000, 12: 6500, 13: 6000, 14: 5500, 15: 5000,
               16: 4000, 17: 2500, 18: 1500, 19: 1000},
    "16+": {4: 4400, 5: 6000, 6: 6000, 7: 6500, 8: 7000, 9: 7000, 10: 7000, 11: 7000,
            12: 6500, 13: 6000, 14: 5500, 15: 5000, 16: 4000, 17: 2500, 18: 1500, 19: 1000},
    "<16": {1: 5000, 2: 5500, 3: 5500, 4: 1100},
    "0to25": {1: 5000, 2: 5500, 3: 5500, 4: 5500, 5: 6000, 6: 1200},
    "11to25": {3: 4400, 4: 5500, 5: 6000, 6: 1200},
    "15to25": {4: 5500, 5: 6000, 6: 1200},
}

# Retired area codes and their current replacements.
CODE_HISTORY = [
    ("S12000015", "S12000047"), ("S12000024", "S12000048"),
    ("S12000046", "S12000049"), ("S12000044", "S12000050"),
    ("S08000018", "S08000029"), ("S08000027", "S08000030"),
    ("S08000021", "S08000031"), ("S08000023", "S08000032"),
    ("S37000014", "S37000032"), ("S37000023", "S37000033"),
    ("S92000003", "S00000001"),
]

# National code and level prefixes.
SCOTLAND = "S00000001"
LEVEL_PREFIX = {"hb": "S08", "ca": "S12", "hscp": "S37", "adp": "S11",
                "locality": "S99", "iz": "S02", "dz": "S01"}
# Expected number of areas per level in one period (QA coverage check).
EXPECTED_AREAS = {"S08": 14, "S12": 32, "S11": 30, "S37": 31, "S02": 1279}


def epop_total(epop_age: str, sexes: int = 2) -> int:
    """Standard population total implied by a cut: sexes x sum of its weights."""
    return sexes * sum(EPOP_WEIGHTS[epop_age].values())


def epop_table(spark: SparkSession, epop_age: str | None = None) -> DataFrame:
    """(epop_age, age_grp, epop) rows for one cut or all cuts."""
    cuts = [epop_age] if epop_age else list(EPOP_WEIGHTS)
    rows = [(cut, band, float(w)) for cut in cuts for band, w in EPOP_WEIGHTS[cut].items()]
    return spark.createDataFrame(rows, "epop_age string, age_grp int, epop double")


def code_history_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CODE_HISTORY, "old_code string, new_code string")


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small literal DataFrame, hinted for broadcast (its size is the literal's)."""
    return F.broadcast(spark.createDataFrame(rows, schema))


# Council area -> alcohol & drug partnership.  Two partnerships
# each cover two councils (S11000051, S11000052).
COUNCIL_TO_ADP = [
    ("S12000005", "S11000005"), ("S12000006", "S11000006"), ("S12000008", "S11000008"),
    ("S12000010", "S11000051"), ("S12000011", "S11000011"), ("S12000014", "S11000013"),
    ("S12000017", "S11000016"), ("S12000018", "S11000017"), ("S12000019", "S11000051"),
    ("S12000020", "S11000019"), ("S12000021", "S11000020"), ("S12000026", "S11000025"),
    ("S12000028", "S11000027"), ("S12000029", "S11000052"), ("S12000030", "S11000029"),
    ("S12000033", "S11000001"), ("S12000034", "S11000002"), ("S12000035", "S11000004"),
    ("S12000036", "S11000012"), ("S12000038", "S11000024"), ("S12000039", "S11000030"),
    ("S12000040", "S11000031"), ("S12000041", "S11000003"), ("S12000042", "S11000007"),
    ("S12000050", "S11000052"), ("S12000045", "S11000009"), ("S12000049", "S11000015"),
    ("S12000047", "S11000014"), ("S12000048", "S11000023"), ("S12000013", "S11000032"),
    ("S12000027", "S11000026"), ("S12000023", "S11000022"),
]


def council_to_adp_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNCIL_TO_ADP, "ca string, adp string")


def values_sql(rows, names) -> str:
    """The same literal rows as a SQL VALUES list (for the oracles)."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(names)})"


# ---------------------------------------------------------------------------
# Relative risks of smoking-related diagnoses, as rules
# (sex or None for both, 3-character diagnosis from, to, age band from, to
# (None = unrestricted), relative risk), first for current smokers, then for
# ex-smokers.  Age bands are the integers of ``age_band`` (quirk Q1: integer,
# not text, comparison).  Deaths use the same rules without the
# admission-only diagnoses (SMOKING_ADMISSION_ONLY).
# ---------------------------------------------------------------------------
SMOKING_RR_CURRENT = [
    (1, "C00", "C14", None, None, 10.89), (2, "C00", "C14", None, None, 5.08),
    (1, "C15", "C15", None, None, 6.76), (2, "C15", "C15", None, None, 7.75),
    (1, "C16", "C16", None, None, 1.96), (2, "C16", "C16", None, None, 1.36),
    (1, "C25", "C25", None, None, 2.31), (2, "C25", "C25", None, None, 2.25),
    (1, "C32", "C32", None, None, 14.60), (2, "C32", "C32", None, None, 13.02),
    (1, "C33", "C34", None, None, 23.26), (2, "C33", "C34", None, None, 12.69),
    (1, "C53", "C53", None, None, 1.0), (2, "C53", "C53", None, None, 1.59),
    (1, "C64", "C66", None, None, 2.50), (1, "C68", "C68", None, None, 2.50),
    (2, "C64", "C66", None, None, 1.40), (2, "C68", "C68", None, None, 1.40),
    (1, "C67", "C67", None, None, 3.27), (2, "C67", "C67", None, None, 2.22),
    (1, "C80", "C80", None, None, 4.40), (2, "C80", "C80", None, None, 2.20),
    (1, "C92", "C92", None, None, 1.80), (2, "C92", "C92", None, None, 1.20),
    (1, "I20", "I25", None, 11, 4.20), (1, "I20", "I25", 12, 13, 2.50),
    (1, "I20", "I25", 14, 15, 1.80), (1, "I20", "I25", 16, None, 1.40),
    (2, "I20", "I25", None, 11, 5.30), (2, "I20", "I25", 12, 13, 2.80),
    (2, "I20", "I25", 14, 15, 2.10), (2, "I20", "I25", 16, None, 1.40),
    (1, "I00", "I09", None, None, 1.78), (1, "I26", "I51", None, None, 1.78),
    (2, "I00", "I09", None, None, 1.49), (2, "I26", "I51", None, None, 1.49),
    (1, "I60", "I69", None, 11, 4.40), (1, "I60", "I69", 12, 13, 3.10),
    (1, "I60", "I69", 14, 15, 2.20), (1, "I60", "I69", 16, None, 1.60),
    (2, "I60", "I69", None, 11, 5.40), (2, "I60", "I69", 12, 13, 3.70),
    (2, "I60", "I69", 14, 15, 2.60), (2, "I60", "I69", 16, None, 1.30),
    (1, "I70", "I70", None, None, 2.44), (2, "I70", "I70", None, None, 1.83),
    (1, "I71", "I71", None, None, 6.21), (2, "I71", "I71", None, None, 7.07),
    (1, "I72", "I78", None, None, 2.07), (2, "I72", "I78", None, None, 2.17),
    (1, "J10", "J18", None, 13, 2.50), (1, "J10", "J18", 14, None, 2.00),
    (2, "J10", "J18", None, 13, 4.30), (2, "J10", "J18", 14, None, 2.20),
    (1, "J40", "J43", None, None, 17.10), (2, "J40", "J43", None, None, 12.04),
    (1, "J44", "J44", None, None, 10.58), (2, "J44", "J44", None, None, 13.08),
    (1, "K25", "K27", None, None, 5.40), (2, "K25", "K27", None, None, 5.50),
    (None, "K50", "K50", None, None, 2.10),
    (None, "K05", "K05", None, None, 3.97),
    (None, "H25", "H25", 10, None, 1.54),
    (None, "S72", "S72", 12, 13, 1.17), (None, "S72", "S72", 14, 15, 1.41),
    (1, "S72", "S72", 16, None, 1.76), (2, "S72", "S72", 16, None, 1.85),
    (2, "O03", "O03", None, None, 1.28),
]
SMOKING_RR_EX = [
    (1, "C00", "C14", None, None, 3.40), (2, "C00", "C14", None, None, 2.29),
    (1, "C15", "C15", None, None, 4.46), (2, "C15", "C15", None, None, 2.79),
    (1, "C16", "C16", None, None, 1.47), (2, "C16", "C16", None, None, 1.32),
    (1, "C25", "C25", None, None, 1.15), (2, "C25", "C25", None, None, 1.55),
    (1, "C32", "C32", None, None, 6.34), (2, "C32", "C32", None, None, 5.16),
    (1, "C33", "C34", None, None, 8.70), (2, "C33", "C34", None, None, 4.53),
    (1, "C53", "C53", None, None, 1.0), (2, "C53", "C53", None, None, 1.14),
    (1, "C64", "C66", None, None, 1.70), (1, "C68", "C68", None, None, 1.70),
    (2, "C64", "C66", None, None, 1.10), (2, "C68", "C68", None, None, 1.10),
    (1, "C67", "C67", None, None, 2.09), (2, "C67", "C67", None, None, 1.89),
    (1, "C80", "C80", None, None, 2.50), (2, "C80", "C80", None, None, 1.30),
    (1, "C92", "C92", None, None, 1.40), (2, "C92", "C92", None, None, 1.30),
    (1, "I20", "I25", None, 11, 2.00), (1, "I20", "I25", 12, 13, 1.60),
    (1, "I20", "I25", 14, 15, 1.30), (1, "I20", "I25", 16, None, 1.10),
    (2, "I20", "I25", None, 11, 2.60), (2, "I20", "I25", 12, 13, 1.10),
    (2, "I20", "I25", 14, 15, 1.20), (2, "I20", "I25", 16, None, 1.20),
    (1, "I00", "I09", None, None, 1.22), (1, "I26", "I51", None, None, 1.22),
    (2, "I00", "I09", None, None, 1.14), (2, "I26", "I51", None, None, 1.14),
    (1, "I60", "I69", None, None, 1.10),
    (2, "I60", "I69", None, 15, 1.30), (2, "I60", "I69", 16, None, 1.0),
    (1, "I70", "I70", None, None, 1.33), (2, "I70", "I70", None, None, 1.0),
    (1, "I71", "I71", None, None, 3.07), (2, "I71", "I71", None, None, 2.07),
    (1, "I72", "I78", None, None, 1.01), (2, "I72", "I78", None, None, 1.12),
    (1, "J10", "J18", None, None, 1.40), (2, "J10", "J18", None, None, 1.10),
    (1, "J40", "J43", None, None, 15.64), (2, "J40", "J43", None, None, 11.77),
    (1, "J44", "J44", None, None, 6.80), (2, "J44", "J44", None, None, 6.78),
    (1, "K25", "K27", None, None, 1.80), (2, "K25", "K27", None, None, 1.40),
    (None, "K50", "K50", None, None, 1.0),
    (None, "K05", "K05", None, None, 1.68),
    (None, "H25", "H25", 10, None, 1.11),
    (None, "S72", "S72", 12, 13, 1.02), (None, "S72", "S72", 14, 15, 1.08),
    (1, "S72", "S72", 16, None, 1.14), (2, "S72", "S72", 16, None, 1.22),
    (2, "O03", "O03", None, None, 1.0),
]
SMOKING_ADMISSION_ONLY = ("K50", "K05", "H25", "S72", "O03")


def smoking_rr_rules(kind: str = "admissions", sexes=(1, 2)) -> tuple[list, list]:
    """(current, ex) rule rows with sex-agnostic rules expanded to every sex, so
    sex is an equi-join key and the diagnosis / age ranges are the join condition."""
    def expand(rules):
        out = []
        for sex, lo, hi, alo, ahi, rr in rules:
            if kind == "deaths" and lo in SMOKING_ADMISSION_ONLY:
                continue
            for s in ([sex] if sex is not None else list(sexes)):
                out.append((s, lo, hi, alo, ahi, float(rr)))
        return out
    return expand(SMOKING_RR_CURRENT), expand(SMOKING_RR_EX)


RR_RULE_SCHEMA = "sex_grp int, diag_lo string, diag_hi string, age_lo int, age_hi int, rr double"


# The deprivation (SIMD) release used for each range of years.
SIMD_RELEASES = [
    ("simd2004", 2002, 2003), ("simd2006", 2004, 2006), ("simd2009v2", 2007, 2009),
    ("simd2012", 2010, 2013), ("simd2016", 2014, 2016), ("simd2020v2", 2017, 2019),
]
