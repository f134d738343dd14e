"""Small literal reference sets (the warehouse's seed data).

Everything here is a few dozen rows at most; it is turned into DataFrames
with ``createDataFrame`` and joined with ``broadcast`` - the size bound is
the literal itself, it never grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES - these must equal the warehouse's seed data for results to
# match. Kept as plain text, in their natural order.
# ---------------------------------------------------------------------------

# Spanish month names, January..December (calendar month_name).
MONTH_NAMES_ES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]

# Spanish day names, Monday..Sunday (ISO day of week 1..7).
DAY_NAMES_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

# Public holidays by MM-DD.
HOLIDAYS = [
    ("01-01", "Año Nuevo"),
    ("01-06", "Día de Reyes"),
    ("01-21", "Día de la Altagracia"),
    ("01-26", "Día de Duarte"),
    ("02-27", "Día de la Independencia"),
    ("05-01", "Día del Trabajo"),
    ("06-11", "Corpus Christi"),
    ("08-16", "Día de la Restauración"),
    ("09-24", "Día de las Mercedes"),
    ("11-06", "Día de la Constitución"),
    ("12-25", "Navidad"),
]

# Salespeople: (salesperson_key, salesperson_id, full_name, zone_key,
# commission_rate, monthly_target). All active.
SALESPEOPLE = [
    (1, "SP-001", "Carlos Batista Pérez", 1, "0.040", "850000"),
    (2, "SP-002", "María González Sánchez", 1, "0.038", "820000"),
    (3, "SP-003", "José Rodríguez Mejía", 1, "0.042", "900000"),
    (4, "SP-004", "Ana Martínez Ortiz", 1, "0.035", "750000"),
    (5, "SP-005", "Luis Fernández Taveras", 2, "0.040", "800000"),
    (6, "SP-006", "Carmen Valdez Peralta", 2, "0.038", "780000"),
    (7, "SP-007", "Roberto Jiménez Cruz", 2, "0.045", "950000"),
    (8, "SP-008", "Patricia Almonte Rivas", 2, "0.035", "720000"),
    (9, "SP-009", "Miguel Ángel Rosario", 3, "0.040", "820000"),
    (10, "SP-010", "Sandra Corporán Díaz", 3, "0.038", "780000"),
    (11, "SP-011", "Ramón Féliz Cepeda", 3, "0.036", "760000"),
    (12, "SP-012", "Yolanda Tejeda Núñez", 4, "0.038", "760000"),
    (13, "SP-013", "Eduardo Pichardo Reyes", 4, "0.035", "720000"),
    (14, "SP-014", "Cecilia Marte Herrera", 4, "0.033", "700000"),
    (15, "SP-015", "Francisco Castillo López", 5, "0.040", "800000"),
]

# Distributors: (distributor_key, distributor_code, distributor_name, distributor_type).
DISTRIBUTORS = [
    (1, "INT", "Ventas Internas", "INTERNO"),
    (2, "DIST_A", "Distribuidora Ramos S.R.L.", "EXTERNO"),
    (3, "DIST_B", "MediFar Dominicana S.A.", "EXTERNO"),
    (4, "DIST_C", "Farmacorp S.A.", "EXTERNO"),
    (5, "DIST_D", "AlphaFarma Group S.R.L.", "EXTERNO"),
    (6, "DIST_E", "BioPharma Distribution S.A.", "EXTERNO"),
    (7, "DIST_F", "MedDist Nacional S.R.L.", "EXTERNO"),
]

# City aliases: normalised alias -> canonical city, in list order (the
# substring step of city cleansing takes the first hit in this order).
CITY_ALIASES = [
    ("santo domingo", "Santo Domingo"),
    ("sd", "Santo Domingo"),
    ("distrito nacional", "Santo Domingo"),
    ("d.n.", "Santo Domingo"),
    ("dn", "Santo Domingo"),
    ("santo domingo este", "Santo Domingo Este"),
    ("sde", "Santo Domingo Este"),
    ("santo domingo norte", "Santo Domingo Norte"),
    ("sdn", "Santo Domingo Norte"),
    ("santo domingo oeste", "Santo Domingo Oeste"),
    ("sdoe", "Santo Domingo Oeste"),
    ("boca chica", "Boca Chica"),
    ("santiago", "Santiago"),
    ("stgo", "Santiago"),
    ("la vega", "La Vega"),
    ("vega", "La Vega"),
    ("puerto plata", "Puerto Plata"),
    ("pp", "Puerto Plata"),
    ("san francisco de macoris", "San Francisco de Macorís"),
    ("san francisco", "San Francisco de Macorís"),
    ("sfm", "San Francisco de Macorís"),
    ("moca", "Moca"),
    ("bonao", "Bonao"),
    ("cotui", "Cotui"),
    ("la romana", "La Romana"),
    ("romana", "La Romana"),
    ("san pedro de macoris", "San Pedro de Macorís"),
    ("san pedro", "San Pedro de Macorís"),
    ("spm", "San Pedro de Macorís"),
    ("higuey", "Higüey"),
    ("higüey", "Higüey"),
    ("hato mayor", "Hato Mayor"),
    ("el seibo", "El Seibo"),
    ("barahona", "Barahona"),
    ("san cristobal", "San Cristóbal"),
    ("san cristóbal", "San Cristóbal"),
    ("azua", "Azua"),
    ("bani", "Bani"),
    ("ocoa", "Ocoa"),
    ("monte cristi", "Monte Cristi"),
    ("mao", "Mao"),
    ("valverde", "Mao"),
    ("dajabon", "Dajabón"),
    ("dajabón", "Dajabón"),
    ("santiago rodriguez", "Santiago Rodríguez"),
    ("nagua", "Nagua"),
    ("samana", "Samaná"),
    ("samaná", "Samaná"),
    ("neiba", "Neiba"),
    ("pedernales", "Pedernales"),
    ("guerra", "Guerra"),
    ("los alcarrizos", "Los Alcarrizos"),
]

# Zone aliases: normalised alias -> zone code (default CAP).
ZONE_ALIASES = [
    ("capital", "CAP"), ("cap", "CAP"),
    ("norte", "NOR"), ("nor", "NOR"),
    ("este", "EST"), ("est", "EST"),
    ("sur", "SUR"),
    ("oeste", "OES"), ("oes", "OES"),
    ("noroeste", "OES"),
    ("nordeste", "NOR"),
]
DEFAULT_ZONE_CODE = "CAP"
DEFAULT_CITY = "Santo Domingo"

# Canonical city -> zone code.
CITY_ZONE = [
    ("Santo Domingo", "CAP"), ("Santo Domingo Este", "CAP"),
    ("Santo Domingo Norte", "CAP"), ("Santo Domingo Oeste", "CAP"),
    ("Boca Chica", "CAP"), ("Guerra", "CAP"), ("Los Alcarrizos", "CAP"),
    ("Santiago", "NOR"), ("La Vega", "NOR"), ("Puerto Plata", "NOR"),
    ("San Francisco de Macorís", "NOR"), ("Moca", "NOR"),
    ("Bonao", "NOR"), ("Cotui", "NOR"), ("Nagua", "NOR"), ("Samaná", "NOR"),
    ("La Romana", "EST"), ("San Pedro de Macorís", "EST"),
    ("Higüey", "EST"), ("Hato Mayor", "EST"), ("El Seibo", "EST"),
    ("Barahona", "SUR"), ("San Cristóbal", "SUR"), ("Azua", "SUR"),
    ("Bani", "SUR"), ("Ocoa", "SUR"), ("Neiba", "SUR"), ("Pedernales", "SUR"),
    ("Monte Cristi", "OES"), ("Mao", "OES"), ("Dajabón", "OES"),
    ("Santiago Rodríguez", "OES"),
]

# Words kept lower case by Spanish title casing (except in first position).
SPANISH_LOWER_WORDS = ["de", "del", "la", "las", "el", "los", "y", "en", "a", "con", "sin"]

# Client-name abbreviation rules, applied in this order, case-insensitive,
# word-bounded: (pattern, replacement).
CLIENT_NAME_RULES = [
    (r"\bFcia\.?\b", "Farmacia"),
    (r"\bFarm\.?\b", "Farmacia"),
    (r"\bDrog\.?\b", "Droguería"),
    (r"\bCía\.?\b", "Compañía"),
    (r"\bCia\.?\b", "Compañía"),
    (r"\bS\.?R\.?L\.?\b", "S.R.L."),
    (r"\bS\.?A\.?\b", "S.A."),
    (r"\bHosp\.?\b", "Hospital"),
    (r"\bClin\.?\b", "Clínica"),
    (r"\bClinica\b", "Clínica"),
]

# Minimum valid sale date; default fuzzy cut-offs (0-100 scale).
MIN_SALE_DATE = "2015-01-01"
CITY_FUZZY_THRESHOLD = 75
PRODUCT_FUZZY_THRESHOLD = 70
# Confidence given by each city-cleansing step.
CITY_CONF_EXACT, CITY_CONF_SUBSTRING, CITY_CONF_UNKNOWN, CITY_CONF_BLANK = 1.0, 0.95, 0.3, 0.5
# Client dimension defaults on insert.
CLIENT_DEFAULT_CREDIT, CLIENT_DEFAULT_TERMS = 50000, 30
# Commission bonus share when the monthly target is met.
BONUS_SHARE = "0.10"

# ---------------------------------------------------------------------------


def salespeople_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("salesperson_key", T.IntegerType(), False),
        T.StructField("salesperson_id", T.StringType(), False),
        T.StructField("full_name", T.StringType(), False),
        T.StructField("sp_zone_key", T.IntegerType(), False),
        T.StructField("commission_rate", T.StringType(), False),
        T.StructField("monthly_target", T.StringType(), False),
    ])
    df = spark.createDataFrame(SALESPEOPLE, schema)
    return (df.withColumn("commission_rate", df.commission_rate.cast("decimal(5,3)"))
              .withColumn("monthly_target", df.monthly_target.cast("decimal(15,2)"))
              .withColumn("active_flag", df.salesperson_key.isNotNull()))


def distributors_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DISTRIBUTORS,
        "distributor_key int, distributor_code string, distributor_name string, distributor_type string")


def holidays_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HOLIDAYS, "mm_dd string, holiday_name string")
