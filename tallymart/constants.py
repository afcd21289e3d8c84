"""Rate cards, keyword lists, dimension rows and thresholds.

Results depend on these exact values, so they are stated literally and in one place.
"""

# --- energy -----------------------------------------------------------------

# (site_id, city, site_type)
SITES = [
    ("SITE_001", "Berlin", "residential"),
    ("SITE_002", "Munich", "commercial"),
    ("SITE_003", "Hamburg", "industrial"),
    ("SITE_004", "Cologne", "residential"),
    ("SITE_005", "Frankfurt", "commercial"),
]

# site_type -> base load in kWh per hour
BASE_LOAD_KWH = {"residential": 0.4, "commercial": 2.5, "industrial": 12.0}

PEAK_FIRST_HOUR = 8
PEAK_LAST_HOUR = 20
PEAK_FACTOR = 1.4
OFF_PEAK_FACTOR = 0.6
WEEKEND_FACTOR = 0.7
WEEKDAY_FACTOR = 1.0
TARIFF_EUR_PER_KWH = 0.28

# --- e-commerce -------------------------------------------------------------

MONTH_END_FIRST_DAY = 25
COMPLETED = "completed"
ORDER_STATUSES = ["completed", "returned", "cancelled"]

# --- weather ----------------------------------------------------------------

# (city, latitude, longitude)
CITIES = [
    ("Bucharest", 44.4268, 26.1025),
    ("Cluj-Napoca", 46.7712, 23.6236),
    ("Iasi", 47.1585, 27.6014),
    ("Timisoara", 45.7489, 21.2087),
    ("Constanta", 44.1598, 28.6348),
]

# --- request logs -----------------------------------------------------------

EVENT_TOPIC = "llm_events"
ROUTED_BY = "llm_router"

# (model, input USD per 1k tokens, output USD per 1k tokens, strength)
MODEL_RATES = [
    ("phi3", 0.0001, 0.0002, "fast and cheap — good for simple questions"),
    ("llama3.2", 0.001, 0.002, "balanced — good general purpose model"),
    ("mistral", 0.002, 0.006, "strong reasoning — good for complex and technical tasks"),
]

# USD per 1k tokens charged at event time when no model card applies
FLAT_INPUT_RATE = 0.01
FLAT_OUTPUT_RATE = 0.03

# any of these inside the prompt keeps it on the small local model
SENSITIVE_KEYWORDS = [
    "password", "secret", "confidential", "parola",
    "ssn", "credit card", "salary", "salariu",
]

# any of these inside a longer prompt sends it to the strong model
TECHNICAL_KEYWORDS = [
    "code", "sql", "python", "error", "debug", "function", "query",
    "script", "bug", "api", "kafka", "dbt", "docker", "pipeline",
]

SHORT_PROMPT_BELOW = 10
LONG_PROMPT_ABOVE = 30
PREVIEW_CHARS = 50

# latency cut-offs in ms: one pair per request, another for a model's mean
REQUEST_FAST_BELOW_MS = 3000
MODEL_FAST_BELOW_MS = 5000
SLOW_FROM_MS = 10000

ANOMALY_FACTOR = 3.0
