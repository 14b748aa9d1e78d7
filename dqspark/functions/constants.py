"""Fixed values.

These values must equal the ones the original registry-cleaning workflow
used, otherwise results differ.  They are stated plainly, in their natural
order, and kept together here.  Patterns are Python ``re`` texts; the
``functions.text`` module turns them into Java-regex column expressions and
``__spark_entry__`` formats them for DuckDB.
"""

# --- fixed values: patterns -------------------------------------------------
KEY_PATTERN = r"^\d{2}-\d{2}-\d{4}-\d{2}$"
PHONE_PATTERN = r"^\d{8}$"
JUNK_PATTERN = r"^[\s\-_.\?*#/\\=]+$"
JUNK_EXT_PATTERN = r"^[\s\-_.,;:\?*#/\\=]+$"
ZONE_PATTERN = r"^ZONA\s+\d+$"            # case-insensitive
ZERO_TYPO_PATTERN = r"[A-Za-zÀ-ÿ]0(?![0-9])"
DIGIT_PATTERN = r"\d"
LETTER_PATTERN = r"[A-Za-z]"
MULTI_WS_PATTERN = r"\s{2,}"
CORRUPT_CHAR = "�"

# --- fixed values: placeholder, threshold, separators -----------------------
PLACEHOLDER = "DESCONOCIDO"
FUZZY_THRESHOLD = 95
FUZZY_TEXT_SEPARATOR = " | "
NONE_TEXT = "Ninguno"

# --- fixed values: disguised null tokens (compared after upper + strip) -----
DISGUISED_NULL_TOKENS = (
    "N/A", "N.A", "NA", "S/N", "S/D", "SD",
    "NULL", "NUL", "NONE",
    ".", "..", "...",
    "SIN DATO", "SIN DATOS", "SIN INFORMACION", "SIN INFORMACIÓN",
    "NO APLICA", "NO DISPONIBLE", "NO REGISTRA", "NINGUNO", "NINGUNA",
    "DESCONOCIDO", "DESCONOCIDA", "0",
)

# --- fixed values: catalogues of the registry --------------------------------
DEPARTMENTS = (
    "GUATEMALA", "EL PROGRESO", "SACATEPEQUEZ", "CHIMALTENANGO", "ESCUINTLA",
    "SANTA ROSA", "SOLOLA", "TOTONICAPAN", "QUETZALTENANGO", "SUCHITEPEQUEZ",
    "RETALHULEU", "SAN MARCOS", "HUEHUETENANGO", "QUICHE", "BAJA VERAPAZ",
    "ALTA VERAPAZ", "PETEN", "IZABAL", "ZACAPA", "CHIQUIMULA", "JALAPA",
    "JUTIAPA",
)
SECTORS = ("OFICIAL", "PRIVADO", "COOPERATIVA", "MUNICIPAL")
LEVELS = ("PREPRIMARIA", "PRIMARIA", "BASICO", "DIVERSIFICADO")
CAPITAL_ALIAS = {"CIUDAD CAPITAL": "GUATEMALA"}
ZONE_REPLACEMENT = "GUATEMALA"

# --- fixed values: ingest -----------------------------------------------------
REQUIRED_HEADERS = (
    "CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO",
    "DIRECCION", "TELEFONO", "NIVEL", "SECTOR",
)
HEADER_MARKERS = ("CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO")
ENCODING_MARKER = "CODIGO"
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")

# Strings the pandas CSV reader turns into missing values by default.
PANDAS_NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: example sizes ----------------------------------------------
EXAMPLES_K = 5
DUPLICATE_EXAMPLES_K = 10
