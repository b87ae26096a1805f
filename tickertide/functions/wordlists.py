"""Word lists used by the text functions."""

# English stopwords without apostrophe forms (cleaned text holds no apostrophes).
ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren",
    "couldn", "didn", "doesn", "hadn", "hasn", "haven", "isn", "ma", "mightn", "mustn",
    "needn", "shan", "shouldn", "wasn", "weren", "won", "wouldn",
]

# Market words that stay although they look like stopwords.
MARKET_KEEP = [
    "up", "down", "high", "low", "not", "no", "bull", "bear",
    "buy", "sell", "loss", "gain", "crash", "rally", "above", "below",
]

STOPWORDS = [w for w in ENGLISH_STOPWORDS if w not in MARKET_KEEP]

# Words dropped after lemmatising.
NOISE_WORDS = ["removed", "deleted", "post", "amp", "http"]

# Capital runs that are not ticker symbols.
NOT_TICKERS = [
    "I", "A", "THE", "AND", "OR", "BUT", "IN", "ON", "AT", "TO", "FOR",
    "OF", "IS", "IT", "BE", "DO", "BY", "AN", "MY", "WE", "US", "UP",
    "DOWN", "NOT", "NO", "YES", "SO", "AS", "IF", "ALL", "ARE", "WAS",
    "HAS", "HAD", "CAN", "WILL", "JUST", "NOW", "NEW", "OLD", "BIG",
    "GET", "GOT", "PUT", "SET", "LET", "ETA", "TBD", "TIL", "IMO",
    "IMHO", "LOL", "OMG", "CEO", "CFO", "CTO", "IPO", "ETF",
    "NFT", "GDP", "CPI", "FED", "SEC", "NYSE", "NASDAQ", "SP", "DOW",
    "USA", "UK", "EU", "DD", "YOY", "QOQ", "PE", "EPS", "ATH",
    "YOLO", "FOMO", "FUD", "HODL", "BUY", "SELL", "CALL", "DCA",
]

# Contractions the tokeniser splits (first part, second part).
SPLIT_CONTRACTIONS = [
    ("can", "not"), ("gon", "na"), ("got", "ta"), ("gim", "me"), ("lem", "me"), ("wan", "na"),
]

# Fixed values of the published lexicon rules (Hutto & Gilbert, ICWSM 2014).
BOOST_UP = [
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply",
    "enormously", "entirely", "especially", "exceptionally", "extremely", "fabulously",
    "fully", "greatly", "highly", "hugely", "incredibly", "intensely", "majorly", "more",
    "most", "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
    "thoroughly", "totally", "tremendously", "unbelievably", "unusually", "utterly", "very",
]
BOOST_DOWN = [
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally", "occasionally",
    "partly", "scarcely", "slightly", "somewhat", "sorta",
]
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont",
    "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neednt", "neither", "never",
    "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt",
    "uhuh", "wasnt", "werent", "without", "wont", "wouldnt", "rarely", "seldom", "despite",
]

# A small seed lexicon of our own; jobs take any (term, valence) table instead.
SEED_LEXICON = [
    ("good", 1.9), ("great", 3.1), ("gain", 2.0), ("gains", 2.0), ("profit", 1.9),
    ("profits", 1.9), ("bullish", 2.4), ("rally", 1.8), ("beat", 1.2), ("strong", 2.3),
    ("growth", 1.6), ("win", 2.8), ("happy", 2.7), ("love", 3.2), ("best", 3.2),
    ("upgrade", 1.6), ("surge", 1.5), ("moon", 1.4), ("safe", 1.9), ("solid", 1.7),
    ("bad", -2.5), ("loss", -1.3), ("losses", -1.7), ("crash", -2.7), ("bearish", -2.3),
    ("fear", -2.2), ("weak", -1.9), ("fraud", -2.8), ("worst", -3.1), ("hate", -2.7),
    ("panic", -2.3), ("bankrupt", -2.6), ("downgrade", -1.7), ("scam", -2.7), ("risk", -1.1),
    ("terrible", -2.1), ("dump", -1.6), ("miss", -0.6), ("debt", -1.5), ("warning", -1.4),
]
