"""These must equal the published ones for results to agree."""

INTERSECTIONS = [
    "INT_CENTRE_VILLE",
    "INT_GARE_NORD",
    "INT_PLACE_REPUBLIQUE",
    "INT_AVENUE_PRINCIPALE",
    "INT_MARCHE_CENTRAL",
    "INT_QUARTIER_EST",
    "INT_ZONE_INDUSTRIELLE",
    "INT_CAMPUS_UNIV",
]

DIRECTIONS = ["NORD", "SUD", "EST", "OUEST"]

VEHICLE_TYPES = ["voiture", "camion", "moto", "bus", "velo"]

# Incident type -> severity, shortest and longest duration in minutes, frequency.
INCIDENT_TYPES = {
    "ACCIDENT": ("HIGH", 15, 60, 0.05),
    "TRAVAUX": ("MEDIUM", 60, 480, 0.03),
    "VEHICULE_EN_PANNE": ("LOW", 10, 30, 0.08),
    "MANIFESTATION": ("HIGH", 60, 180, 0.02),
    "INONDATION": ("CRITICAL", 30, 120, 0.01),
    "CONTROLE_POLICE": ("MEDIUM", 15, 45, 0.06),
}

# Severity -> lowest and highest capacity reduction factor.
CAPACITY_REDUCTION = {
    "LOW": (0.1, 0.2),
    "MEDIUM": (0.3, 0.5),
    "HIGH": (0.5, 0.8),
    "CRITICAL": (0.8, 1.0),
}

SEVERITY_RANK = {"NONE": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}

MODE_LABEL = {
    "FLUID": "GREEN",
    "MODERATE": "YELLOW",
    "DENSE": "ORANGE",
    "CONGESTION": "RED",
    "EMERGENCY": "STOP",
}

MODE_SYMBOL = {
    "FLUID": "🟢",
    "MODERATE": "🟡",
    "DENSE": "🟠",
    "CONGESTION": "🔴",
    "EMERGENCY": "⛔",
}

SEVERITY_SYMBOL = {
    "NONE": "⚪",
    "LOW": "🟡",
    "MEDIUM": "🟠",
    "HIGH": "🔴",
    "CRITICAL": "⛔",
}

DEFAULT_DURATION_MIN = 30
CYCLE_SECONDS = 90
MIN_SPEED_KMH = 5.0
SLA_MS = 3000
HISTORY_SIZE = 1000

EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
