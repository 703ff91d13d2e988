"""Rule values: code dictionaries, thresholds and published labels.

Everything here is plain data. Operators take these values as arguments, so a
caller with other codes passes other values; ``Rules`` bundles one set.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- fixed values: region, wages, thresholds -------------------------------------
REGION_NAME = "RMF"
REGION_AREAS = {
    230100: "Aquiraz",
    230350: "Cascavel",
    230370: "Caucaia",
    230395: "Chorozinho",
    230428: "Eusébio",
    230440: "Fortaleza",
    230495: "Guaiúba",
    230523: "Horizonte",
    230625: "Itaitinga",
    230765: "Maracanaú",
    230770: "Maranguape",
    230960: "Pacajus",
    230970: "Pacatuba",
    231020: "Paracuru",
    231025: "Paraipaba",
    231085: "Pindoretama",
    231240: "São Gonçalo do Amarante",
    231260: "São Luís do Curu",
    231350: "Trairi",
}
STATE_PREFIX = "23"
METRO_CODE = "23"
MINIMUM_WAGE = {
    2020: 1045.0,
    2021: 1100.0,
    2022: 1212.0,
    2023: 1320.0,
    2024: 1412.0,
    2025: 1518.0,
    2026: 1621.0,
}
WAGE_FLOOR = 0.3
WAGE_CEILING = 30.0
MONTHLY_UNIT = "5"
WEEKS_PER_MONTH = 4.345
WINDOW_MONTHS = 12
PRELIMINARY_MONTHS = 3
MIN_SAMPLE = 30

# --- fixed values: code -> conformed label ---------------------------------------
FLOW_SEX = {"1": "Homem", "3": "Mulher"}
FLOW_RACE = {"1": "Branca", "2": "Preta", "3": "Parda", "4": "Amarela", "5": "Indígena"}
STOCK_SEX = {"1": "Homem", "2": "Mulher"}
STOCK_RACE = {"1": "Indígena", "2": "Branca", "4": "Preta", "6": "Amarela", "8": "Parda"}
SURVEY_SEX = {"1": "Homem", "2": "Mulher"}
SURVEY_RACE = {"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indígena"}
APPRENTICE = "103"

# --- fixed values: bands, lower bound first --------------------------------------
AGE_BANDS = [(15, 17, "15-17"), (18, 24, "18-24"), (25, 29, "25-29")]
AGE_BELOW = "<15"
AGE_ABOVE = "30+"
YOUNG = ["15-17", "18-24", "25-29"]
RATIO_BANDS = [
    (1, "1. Até 1 SM"),
    (1.5, "2. 1 a 1,5 SM"),
    (2, "3. 1,5 a 2 SM"),
    (3, "4. 2 a 3 SM"),
    (5, "5. 3 a 5 SM"),
]
RATIO_ABOVE = "6. Mais de 5 SM"
NO_MONTHLY_WAGE = "Sem salário mensal"
NO_PAY = "Sem remuneração informada"
HOUR_BANDS = [(30, "1. Até 30 horas"), (40, "2. 31 a 40 horas"), (44, "3. 41 a 44 horas")]
HOUR_ABOVE = "4. 45 horas ou mais"

# --- fixed values: stock rules ----------------------------------------------------
INDUSTRY_SUBSECTORS = list(range(1, 16))
SERVICE_SUBSECTORS = [16, 17, 18, 19, 20, 21, 22, 23, 25]
PUBLIC_SUBSECTOR = 24
INDUSTRY_SIZES = {
    1: "Micro", 2: "Micro", 3: "Micro", 4: "Micro", 5: "Pequena",
    6: "Pequena", 7: "Média", 8: "Média", 9: "Grande", 10: "Grande",
}
SERVICE_SIZES = {
    1: "Micro", 2: "Micro", 3: "Micro", 4: "Pequena", 5: "Pequena",
    6: "Média", 7: "Grande", 8: "Grande", 9: "Grande", 10: "Grande",
}
SIZE_ELIGIBLE_NATURES = [
    2046, 2054, 2062, 2135, 2232, 2240, 2259, 2267, 2283, 2291,
    2305, 2313, 2321, 2330, 2348, 4014, 4022, 4081, 4111, 4120,
]
STATUTORY_TYPES = [30, 31, 35]
NON_TURNOVER_REASONS = [21, 30, 31, 60, 62, 63, 64, 70, 71, 72, 73, 74, 75, 76, 78, 79, 80]

# --- fixed values: survey rules ---------------------------------------------------
UNREGISTERED_POSITIONS = [2, 4]
POSITIONS_NEEDING_REGISTRY = [8, 9]
FAMILY_HELPER_POSITIONS = [10]
NO_REGISTRY = 2
OWN_ACCOUNT = 9
WORKING_AGE = 14

# --- fixed values: published labels -----------------------------------------------
UNKNOWN_F = "Não informada"
UNKNOWN_M = "Não informado"
NOT_APPLICABLE = "Não se aplica"
ALL = "Todos"
ALL_MONTHS = "Últimos 12 meses"
CORE_AREA = "Fortaleza"
OTHER_AREAS = "Demais municípios da RMF"
YOUNG_PUBLIC = "Jovens (15 a 29 anos)"
OTHER_PUBLIC = "Demais"
RACE_WHITE = "Branca"
RACE_BLACK = "Negra (preta ou parda)"
RACE_BLACK_MEMBERS = ["Preta", "Parda"]
RACE_OTHER = "Outras ou ignorada"
POSITION_LABELS = {
    1: "Empregado no setor privado com carteira",
    2: "Empregado no setor privado sem carteira",
    3: "Trabalhador doméstico com carteira",
    4: "Trabalhador doméstico sem carteira",
    5: "Empregado no setor público com carteira",
    6: "Empregado no setor público sem carteira",
    7: "Militar e servidor estatutário",
    8: "Empregador",
    9: "Conta própria",
    10: "Trabalhador familiar auxiliar",
}
MAJOR_GROUP_LABELS = {
    "0": "0. Forças armadas, policiais e bombeiros militares",
    "1": "1. Dirigentes e gerentes",
    "2": "2. Profissionais das ciências e das artes",
    "3": "3. Técnicos de nível médio",
    "4": "4. Trabalhadores de serviços administrativos",
    "5": "5. Trabalhadores dos serviços e vendedores",
    "6": "6. Trabalhadores agropecuários, florestais e da pesca",
    "7": "7. Trabalhadores da produção de bens e serviços industriais",
    "8": "8. Trabalhadores da produção industrial (processos contínuos)",
    "9": "9. Trabalhadores de reparação e manutenção",
}
OCCUPATION_PREFIX = "CBO "

# --- fixed values: fixed-width layout, field -> [start, end) counted from 0 -------
SURVEY_LAYOUT = {
    "ano": (0, 4),
    "trimestre": (4, 5),
    "uf": (5, 7),
    "capital": (7, 9),
    "rm_ride": (9, 11),
    "peso": (49, 64),
    "sexo": (94, 95),
    "idade": (103, 106),
    "cor_raca": (106, 107),
    "negocio_cnpj": (185, 186),
    "nivel_instrucao": (404, 405),
    "condicao_forca_trabalho": (408, 409),
    "condicao_ocupacao": (409, 410),
    "forca_trabalho_potencial": (410, 411),
    "subocupacao": (412, 413),
    "desalento": (413, 414),
    "posicao_categoria": (416, 418),
    "grupamento_atividade": (418, 420),
    "grupamento_ocupacional": (420, 422),
    "contribuicao_previdenciaria": (422, 423),
    "rendimento_habitual": (443, 451),
    "rendimento_efetivo": (451, 459),
}


def firm_size_rows() -> list[tuple[int, int, str]]:
    """(subsector, size class, firm size) for every pair that has a size: 24 x 10 rows."""
    groups = ((INDUSTRY_SUBSECTORS, INDUSTRY_SIZES), (SERVICE_SUBSECTORS, SERVICE_SIZES))
    return [
        (subsector, size, label)
        for subsectors, sizes in groups
        for subsector in subsectors
        for size, label in sizes.items()
    ]


@dataclass(frozen=True)
class Rules:
    """One set of region, wage and code rules. The defaults are the published ones."""

    areas: Mapping[int, str] = field(default_factory=lambda: REGION_AREAS)
    region: str = REGION_NAME
    wages: Mapping[int, float] = field(default_factory=lambda: MINIMUM_WAGE)
    flow_sex: Mapping[str, str] = field(default_factory=lambda: FLOW_SEX)
    flow_race: Mapping[str, str] = field(default_factory=lambda: FLOW_RACE)
    stock_sex: Mapping[str, str] = field(default_factory=lambda: STOCK_SEX)
    stock_race: Mapping[str, str] = field(default_factory=lambda: STOCK_RACE)
    survey_sex: Mapping[str, str] = field(default_factory=lambda: SURVEY_SEX)
    survey_race: Mapping[str, str] = field(default_factory=lambda: SURVEY_RACE)
