"""Lists, maps and thresholds that decide the results.

They are defaults only; every operator takes its own values as parameters.
"""

# Points per offence type, and the points of an unknown type.
SEVERITY_POINTS = {
    "Spam/Self-Promo": 1,
    "Toxicity": 3,
    "Malicious Link": 5,
    "Toxicity Zero-Tolerance": 5,
}
DEFAULT_SEVERITY = 1

# Hosts whose links are never looked up.
TRUSTED_DOMAINS = (
    "youtube.com",
    "youtu.be",
    "media.tenor.com",
    "tenor.com",
    "google.com",
    "google.test",
)

# Character substitutions undone before the word check.
LEET_MAP = {
    "4": "a",
    "@": "a",
    "3": "e",
    "8": "b",
    "!": "i",
    "1": "i",
    "0": "o",
    "5": "s",
    "$": "s",
    "7": "t",
    "+": "t",
    "9": "g",
    "|": "l",
    "v": "u",
    "z": "s",
}

# Words that are an offence by themselves.
ZERO_TOLERANCE_WORDS = (
    "kys", "kill yourself",
    "nigger", "nigga",
    "faggot", "fag", "fagg",
    "chink", "kike",
    "retard", "retarded", "retarde",
)

# Words that send a text to the toxicity scorer.
TRIGGER_WORDS = (
    "ass", "asshat", "shit", "bullshit",
    "cunt", "fuck", "sucks", "suck",
    "dummy", "dumb", "dum", "stupid", "idiot",
)

# Phrases of spam and self-promotion.
SPAM_PHRASES = (
    "free nitro",
    "dm me for",
    "check out my server",
    "join my discord",
    "join my server",
    "invite link",
    "airdrop",
    "won a prize",
    "crypto giveaway",
    "steam account",
)

# Score above which a toxicity category counts.
TOXICITY_THRESHOLDS = {"insult": 0.9, "threat": 0.9, "sexual_explicit": 0.9}
AUDIT_CATEGORIES = ("toxicity", "insult", "threat", "identity_attack")
AUDIT_FLAG_THRESHOLD = 0.6

# Fraud windows (seconds) and rules.
FRAUD_WINDOW_SECONDS = 600
FRAUD_SLIDE_SECONDS = 300
HIGH_AMOUNT = 500.0
HIGH_COUNT = 5

# Offence names and prompt / label texts.
MALICIOUS_LINK = "Malicious Link"
ZERO_TOLERANCE = "Toxicity Zero-Tolerance"
SPAM = "Spam/Self-Promo"
TOXICITY = "Toxicity"
MANUAL_ADJUSTMENT = "Manual Adjustment"
MANUAL_PARDON = "Manual Pardon"
FALSE_POSITIVE = "False Positive (FP)"
FALSE_NEGATIVE = "False Negative (FN)"
CORRECT = "Correct"
SEPARATOR_PLACEHOLDER = "[SEP_TOKEN]"
PROMPT_COMMENT = "COMMENT TO CLASSIFY: "
PROMPT_RULE = "RULE: "
PROMPT_POSITIVE = "POSITIVE EXAMPLES (Violation): "
PROMPT_NEGATIVE = "NEGATIVE EXAMPLES (No Violation): "
PROMPT_LINK_FLAG = "URL_PRESENT: "
SERIES_DAILY = "Time Series (Daily)"
SERIES_NAME_PART = "Time Series"
SERIES_METRICS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close", "volume": "5. volume"}
LINK_REMOVED = "[LINK REMOVED]"
REDACTED_TLDS = ("com", "org", "net", "gov", "edu", "co")

# Sequence length and special ids of the encoder.
MAX_TOKENS = 512
START_ID, PAD_ID, END_ID = 0, 1, 2

# Default lexicons of the built-in scorers (stand-ins for a pluggable model).
POSITIVE_WORDS = (
    "good", "great", "gain", "gains", "bull", "moon", "up", "love", "win",
    "profit", "happy", "strong", "best", "hodl",
)
NEGATIVE_WORDS = (
    "bad", "loss", "losses", "bear", "crash", "scam", "down", "hate", "lose",
    "fear", "weak", "worst", "worthless",
)
TOXICITY_LEXICON = {
    "insult": ("idiot", "moron", "stupid", "clown", "dumb", "dummy", "worthless", "pathetic", "trash", "scum"),
    "threat": ("kill", "hurt", "destroy"),
    "sexual_explicit": ("porn", "nude"),
    "identity_attack": ("subhuman", "vermin"),
}
