"""Fixed values shared by the operators: dictionaries, scales, topics and class names."""

from __future__ import annotations

# Canonical place, province, accepted spellings, in match order.
PLACES = [
    ("Dera Ghazi Khan", "Punjab", ["d.g khan", "dg khan", "d g khan", "dera ghazi khan"]),
    ("Rahim Yar Khan", "Punjab", ["r.y khan", "ry khan", "r. y khan", "rahim yar khan", "rahimyar khan"]),
    ("Mandi Bahauddin", "Punjab", ["m.b din", "mb din", "m. b din", "mandi bahauddin", "mandi bahaudin"]),
    ("Lahore", "Punjab", ["lahore"]),
    ("Faisalabad", "Punjab", ["faisalabad", "lyallpur"]),
    ("Multan", "Punjab", ["multan"]),
    ("Rawalpindi", "Punjab", ["rawalpindi", "pindi"]),
    ("Karachi", "Sindh", ["karachi"]),
    ("Hyderabad", "Sindh", ["hyderabad"]),
    ("Sukkur", "Sindh", ["sukkur"]),
    ("Peshawar", "Khyber Pakhtunkhwa", ["peshawar"]),
    ("Quetta", "Balochistan", ["quetta"]),
    ("Islamabad", "Islamabad Capital Territory", ["islamabad", "isb"]),
]

# Known coordinates, keyed "lower-case name|lower-case country".
GAZETTEER = [
    ("lahore|pakistan", 31.5497, 74.3436),
    ("d.g khan|pakistan", 30.0561, 70.6346),
    ("r. y khan|pakistan", 28.4202, 70.2952),
    ("karachi|pakistan", 24.8607, 67.0011),
    ("peshawar|pakistan", 34.0151, 71.5249),
    ("quetta|pakistan", 30.1798, 66.975),
    ("islamabad|pakistan", 33.6844, 73.0479),
    ("dera ghazi khan|pakistan", 30.0321374, 70.6401114),
    ("rahim yar khan|pakistan", 28.4225413, 70.3034237),
]

# Coordinates by raw collection-point name, used when the gazetteer misses.
COLLECTION_POINTS = [
    ("Lahore", 31.5497, 74.3436),
    ("D.G Khan", 30.0561, 70.6346),
    ("R. Y Khan", 28.4202, 70.2952),
    ("Karachi", 24.8607, 67.0011),
    ("Peshawar", 34.0151, 71.5249),
    ("Quetta", 30.1798, 66.9750),
    ("Islamabad", 33.6844, 73.0479),
]

COUNTRY = "Pakistan"
UNKNOWN = "UNKNOWN"

# Topic and source tag per stream.
TOPICS = {
    "surveillance": "nih-surveillance-topic",
    "weather": "weather-topic",
    "alerts": "ndma-alerts-topic",
    "policy": "policy-topic",
    "news": "news-topic",
}
SOURCE_TAGS = {
    "surveillance": "NIH_PAKISTAN",
    "weather": "PMD",
    "alerts": "NDMA",
    "policy": "MOCC_PAKISTAN",
}
METRIC_TAGS = {
    "surveillance": "NIH",
    "weather": "WEATHER",
    "alerts": "NDMA",
    "policy": "Policy",
    "news": "RSS/Media",
}
# Folder of each harmonised table below the base folder.
TABLE_FOLDERS = {
    "surveillance": "nih_harmonized",
    "weather": "weather_harmonized",
    "alerts": "ndma_harmonized",
    "policy": "policy_harmonized",
    "news": "news_harmonized",
}
BOOTSTRAP_SERVERS = "localhost:9092"
TRIGGER_INTERVAL = "10 seconds"
ALERT_ID_PREFIX = "NDMA-"
ITEMS_PER_FEED = 5

# Alert severity, mildest first.
SEVERITY_SCALE = ["minor", "moderate", "severe", "catastrophic"]

# Graph vocabulary. The namespace is the caller's; this one is reserved for examples.
NAMESPACE = "http://example.org/kg/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDF_NAMESPACE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD_NAMESPACE = "http://www.w3.org/2001/XMLSchema#"
XSD_INTEGER = XSD_NAMESPACE + "integer"
XSD_DOUBLE = XSD_NAMESPACE + "double"
