"""Class orders, label lists, dictionaries and thresholds.

Everything in this module is a constant that results depend on. Operators take
these as default arguments, so callers can pass their own.
"""

from __future__ import annotations

# ---- fixed values: sentiment classes in display order -----------------------
CLASS_ORDER = ["Extreme Fear", "Fear", "Neutral", "Greed", "Extreme Greed"]
DEFAULT_SENTIMENT_SCORE = 50.0
DEFAULT_SENTIMENT_CLASS = "Neutral"

# ---- fixed values: execution labels -----------------------------------------
LONG_LABELS = ["Buy", "Open Long", "Close Long", "Short > Long"]
SHORT_LABELS = ["Sell", "Open Short", "Close Short", "Long > Short", "Liquidated Isolated Short"]

# ---- fixed values: leverage tiers (size above, choices, probabilities) ------
LEVERAGE_TIERS = [
    (50000, [1, 2, 3, 5], [0.45, 0.40, 0.12, 0.03]),
    (10000, [1, 2, 3, 5, 10], [0.20, 0.35, 0.25, 0.15, 0.05]),
    (1000, [2, 3, 5, 10, 20], [0.10, 0.25, 0.35, 0.20, 0.10]),
    (None, [3, 5, 10, 20, 50], [0.10, 0.20, 0.40, 0.20, 0.10]),
]

# ---- fixed values: leverage buckets (upper bound, label) --------------------
LEVERAGE_BUCKETS = [
    (3, "Low Leverage (1x-3x)"),
    (10, "Medium Leverage (4x-10x)"),
    (20, "High Leverage (11x-20x)"),
    (None, "Extreme Leverage (21x-50x)"),
]
BUCKET_LABELS = [label for _, label in LEVERAGE_BUCKETS]

# ---- fixed values: text patterns --------------------------------------------
FILL_TIME_FORMAT = "dd-MM-yyyy HH:mm"
NON_ASCII_PATTERN = r"[^\x00-\x7F]+"
TAG_PATTERN = r"<[^>]*>"
URL_PATTERN = r"https?://\S+|www\.\S+"
TOKEN_PATTERN = r"\b[a-zA-Z0-9$%\-\.]+\b"

# ---- fixed values: stop words -----------------------------------------------
STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are", "arent", "as",
    "at", "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "cant",
    "cannot", "co", "could", "couldnt", "did", "didnt", "do", "does", "doesnt", "doing", "dont", "down",
    "during", "each", "few", "for", "from", "further", "had", "hadnt", "has", "hasnt", "have", "havent",
    "having", "he", "hed", "hell", "hes", "her", "here", "heres", "hers", "herself", "him", "himself", "his",
    "how", "hows", "i", "id", "ill", "im", "ive", "if", "in", "into", "is", "isnt", "it", "its", "itself",
    "lets", "me", "more", "most", "mustnt", "my", "myself", "no", "nor", "not", "of", "off", "on", "once",
    "only", "or", "other", "ought", "our", "ours", "ourselves", "out", "over", "own", "same", "shant", "she",
    "shed", "shell", "shes", "should", "shouldnt", "so", "some", "such", "than", "that", "thats", "the",
    "their", "theirs", "them", "themselves", "then", "there", "theres", "these", "they", "theyd", "theyll",
    "theyre", "theyve", "this", "those", "through", "to", "too", "under", "until", "up", "very", "was",
    "wasnt", "we", "wed", "well", "were", "weve", "werent", "what", "whats", "when", "whens", "where",
    "wheres", "which", "while", "who", "whos", "whom", "why", "whys", "with", "wont", "would", "wouldnt",
    "you", "youd", "youll", "youre", "youve", "your", "yours", "yourself", "yourselves",
]

# ---- fixed values: sentiment lexicon ----------------------------------------
LEXICON = {
    "approval": 1.0,
    "approved": 1.0,
    "bullish": 1.0,
    "inflows": 1.0,
    "surged": 1.0,
    "squeeze": 1.0,
    "breakout": 1.0,
    "growth": 1.0,
    "adoption": 1.0,
    "parabolic": 1.0,
    "buy": 0.5,
    "bull": 0.5,
    "rally": 0.5,
    "gain": 0.5,
    "profit": 0.5,
    "support": 0.5,
    "inflow": 0.5,
    "positive": 0.5,
    "sell": -0.5,
    "bear": -0.5,
    "decline": -0.5,
    "loss": -0.5,
    "resistance": -0.5,
    "outflow": -0.5,
    "negative": -0.5,
    "audit": -0.5,
    "bearish": -1.0,
    "liquidation": -1.0,
    "liquidations": -1.0,
    "outflows": -1.0,
    "crunch": -1.0,
    "exploit": -1.0,
    "hack": -1.0,
    "hacked": -1.0,
    "panic": -1.0,
    "exploding": -1.0,
    "crackdown": -1.0,
    "lawsuit": -1.0,
    "fraud": -1.0,
    "scam": -1.0,
}

# ---- fixed values: topic themes, in tie-breaking order ----------------------
THEMES = {
    "ETF Approval": ["etf", "ethereum", "solana", "approved", "approval", "filing", "blackrock", "fidelity"],
    "Regulation": ["regulation", "regulators", "sec", "cftc", "proposal", "treasury", "self-custody", "kyc"],
    "Institutional Adoption": ["adoption", "institutional", "institutions", "blackrock", "fidelity", "fund", "assets"],
    "Exchange Activity": ["exchange", "exchanges", "withdrawals", "outflows", "binance", "coinbase", "liquidity"],
    "Macroeconomic Events": ["macro", "macroeconomic", "fed", "federal", "rates", "funding", "inflation", "treasury"],
    "Security Breaches": ["security", "breach", "breaches", "exploit", "hack", "hacked", "bridge", "drained"],
    "Market Liquidity": ["liquidity", "crunch", "outflows", "withdrawals", "volume", "friction", "liquidation"],
}
DEFAULT_THEME = "Macroeconomic Events"

# ---- fixed values: entity keywords by type, and display names ---------------
ENTITY_KEYWORDS = {
    "Coin": ["btc", "eth", "sol", "bitcoin", "ethereum", "solana", "xrp", "arbitrum", "popcat"],
    "Exchange": ["binance", "coinbase", "kraken", "okx", "perpetual", "uniswap"],
    "Regulator": ["sec", "cftc", "treasury", "fca", "fed", "federal reserve"],
    "Institution": ["blackrock", "fidelity", "grayscale", "microstrategy", "sec"],
    "Country": ["us", "usa", "europe", "china", "uk", "germany"],
}
ENTITY_NAMES = {
    "btc": "Bitcoin (BTC)",
    "bitcoin": "Bitcoin (BTC)",
    "eth": "Ethereum (ETH)",
    "ethereum": "Ethereum (ETH)",
    "sol": "Solana (SOL)",
    "solana": "Solana (SOL)",
    "binance": "Binance",
    "coinbase": "Coinbase",
    "sec": "SEC (Securities and Exchange Commission)",
    "cftc": "CFTC",
    "blackrock": "BlackRock",
    "fidelity": "Fidelity",
    "grayscale": "Grayscale",
    "us": "United States",
    "usa": "United States",
    "europe": "Europe",
}

# ---- fixed values: impact scoring -------------------------------------------
SOURCE_CREDIBILITY = {
    "Binance News": 95.0,
    "CoinDesk": 90.0,
    "Yahoo Finance Crypto": 85.0,
    "CoinTelegraph": 80.0,
}
DEFAULT_CREDIBILITY = 60.0
CRITICAL_KEYWORDS = {
    "etf": 1.0,
    "sec": 1.0,
    "approved": 1.0,
    "hack": 1.0,
    "exploit": 1.0,
    "liquidation": 0.8,
    "liquidations": 0.8,
    "cftc": 0.8,
    "blackrock": 0.9,
    "fidelity": 0.8,
    "court": 0.7,
    "treasury": 0.7,
    "insolvency": 1.0,
    "outflow": 0.5,
}

# ---- fixed values: attribution baselines ------------------------------------
# feature: (baseline, unit of distance, turning point, sign up to it, sign above it)
ATTRIBUTION_RULES = {
    "leverage": (8.5, 8.5, 0.0, -1.0, -1.0),
    "size_usd": (5000.0, 5000.0, 0.0, -1.0, -1.0),
    "sentiment_score": (50.0, 50.0, 45.0, -0.5, 1.0),
    "hour": (12.0, 12.0, 0.0, 1.0, 1.0),
}
FLAG_RULE = (0.25, 1.0, 0.0, 1.0, 1.0)
DEFAULT_IMPORTANCE = 0.01
