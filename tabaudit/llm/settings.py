"""Production parameters of the registered queries and the pipeline."""

# Host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

# Wanted shares of tokens; "*" stands for all other values.
MIX_TARGETS = {
    "source": {f"src{i}": 0.05 for i in range(20)} | {"*": 0.05},
    "lang": {"en": 0.45, "fr": 0.2, "de": 0.2, "es": 0.13, "*": 0.02},
    "topic": {"prose": 0.8, "figures": 0.1, "licence": 0.07, "table": 0.03},
}
