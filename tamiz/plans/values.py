"""Fixed values of the academic warehouse.

They decide results and therefore stand here as plain data: domains, code maps,
names and the members that stand for unknown values.
"""

# Period number -> official period code.
PERIOD_CODES = {
    "1": "P0001", "2": "P0002", "3": "P0003", "4": "P0004", "5": "P0005",
    "6": "P0006", "7": "P0007", "8": "P0008", "9": "P0009", "10": "R001",
    "11": "P0010", "12": "P0011", "13": "R002", "14": "P0012", "15": "P0013",
    "16": "R003", "17": "P0014", "18": "P0015", "19": "P0016", "20": "P0017",
    "21": "P0018", "22": "P0019", "23": "P0020",
}

# The 24 provinces of Ecuador.
PROVINCES = [
    "AZU", "BOL", "CAÑAR", "CARCH", "CHI", "ELORO", "ESM", "GAPAG", "GUA", "IMB",
    "LOJ", "LRIOS", "MANA", "MONAS", "NAPO", "ORELA", "PAST", "PIC", "PP", "SAEL",
    "SUCBI", "TUN", "ZAMO", "ZARUM",
]

# Small domains.
SEX_NAMES = ["FEMENINO", "MASCULINO"]
SEX_CODES = ["FEM", "MAS"]
APPROVAL_FORMS = ["PRI", "REP", "CON"]

# Nationality categories, first rule that holds wins.
NATIONALITY_RULES = [
    ("regex", "^ECU[A-Z]*$", "ECUATORIANA"),
    ("equals", "RIOBAMBA", "ECUATORIANA"),
    ("contains", "AUSTRIAC", "AUSTRIACA"),
    ("contains", "CHIN", "CHINA"),
    ("contains", "COLOMB", "COLOMBIANA"),
]
NATIONALITY_UNKNOWN = "DESCONOCIDA"
NATIONALITY_HOME = "ECUATORIANA"

# Members for unknown values.
UNKNOWN_CITY = "DES"
UNKNOWN_NAME = "DESCONOCIDO"
UNKNOWN_CODE = "ND"
UNKNOWN_BIRTH_DATE = "1900-01-01"
EARLIEST_DEGREE = "1990-01-01"
VALID_FROM = "1900-01-01 00:00:00"
VALID_TO = "2199-12-31 23:59:59"

# Date pattern of the period file, label of remedial periods.
PERIOD_DATE = "d/MM/yy"
REMEDIAL_PREFIX = "R"
REMEDIAL_LABEL = "REMEDIAL"

# Calendar names.
MONTHS = [
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO",
    "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
]
WEEKDAYS = ["LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO"]
HALF_YEARS = ["PRIMER SEM.", "SEGUNDO SEM."]
MONTH_BY_NUMBER = {f"{i:02d}": name for i, name in enumerate(MONTHS, start=1)}

# Country of the geographic dimension.
COUNTRY_CODE = "EC"
COUNTRY_NAME = "ECUADOR"

# Words of the census sheet.
LEVEL1_WORD = "PROVINCIA"
LEVEL1_PREFIX = r"PROVINCIA\s+(DE(L?|LA)?\s+)?"
LEVEL2_WORD = "CANTÓN"
SKIP_WORD = "COMPRENDE"
