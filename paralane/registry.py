"""Column names, language codes and the schemas of the tables."""

from pyspark.sql import types as T

PAIR_COLUMNS = ("src", "tgt", "src_lang", "tgt_lang")
DEFAULT_DOMAIN = "general"

PAIR_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*PAIR_COLUMNS, "domain")]
)

# Language codes, their display names and scripts.
ENGLISH, NEPALI, MAITHILI = "eng_Latn", "npi_Deva", "mai_Deva"
DISPLAY_NAMES = {ENGLISH: "English", NEPALI: "Nepali", MAITHILI: "Maithili"}
DEVANAGARI = (NEPALI, MAITHILI)
LATIN = (ENGLISH,)

# The suffix of a language's text files, and the directions made of one triplet.
FILE_LANGUAGES = {"english": ENGLISH, "nepali": NEPALI, "maithili": MAITHILI}
DIRECTIONS = (
    (ENGLISH, NEPALI),
    (NEPALI, ENGLISH),
    (ENGLISH, MAITHILI),
    (MAITHILI, ENGLISH),
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("git_commit", T.StringType()),
        T.StructField("config_hash", T.StringType()),
        T.StructField("dataset_hash", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("training_duration_seconds", T.DoubleType()),
        T.StructField("final_metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("environment", T.MapType(T.StringType(), T.StringType())),
        T.StructField("global_step", T.LongType()),
        T.StructField("epoch", T.DoubleType()),
    ]
)
