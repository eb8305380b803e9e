"""Fixed word lists and constants.

FIXED VALUES: these must equal the values the original pipeline used, or keyword,
topic and image-link results change. They are listed plainly, in their original order.
"""

# FIXED VALUES -- base stop-word list (125 distinct words; "been" appears twice in the source list).
STOP_WORDS = (
    "the", "and", "for", "that", "with", "this", "are", "was", "were", "been",
    "but", "not", "you", "your", "all", "can", "had", "her", "his", "him",
    "how", "its", "may", "new", "now", "old", "see", "way", "who", "did",
    "get", "has", "have", "just", "more", "also", "been", "from", "they",
    "will", "what", "when", "where", "which", "their", "there", "these",
    "those", "would", "about", "could", "other", "than", "then", "them",
    "into", "some", "such", "only", "over", "very", "after", "before",
    "being", "between", "both", "each", "because", "does", "during",
    "should", "while", "here", "most", "much", "many", "well", "back",
    "like", "make", "made", "know", "think", "still", "even", "take",
    "come", "want", "say", "said", "use", "used", "first", "going",
    "people", "thing", "things", "really", "good", "great", "right",
    "look", "long", "little", "big", "keep", "let", "put", "give",
    "tell", "need", "every", "own", "through", "our", "out", "any",
    "time", "day", "too", "don", "one", "two", "off", "got", "why",
)

# FIXED VALUES -- extra stop words used by the embedding-comparison experiment.
EXPERIMENT_EXTRA_STOP_WORDS = ("http", "https", "www", "com", "reddit", "post", "posts")

# FIXED VALUES -- topic dictionary, in dictionary order (ties between topics keep this order).
TOPICS = (
    ("Technology", ("ai", "software", "hardware", "computer", "app", "tech", "code",
                    "programming", "algorithm", "data", "machine", "learning", "robot",
                    "digital", "internet", "cyber", "cloud", "api", "device", "gpu",
                    "cpu", "neural", "model", "automation", "blockchain")),
    ("Science", ("research", "study", "scientist", "experiment", "discovery",
                 "physics", "chemistry", "biology", "space", "quantum", "genome",
                 "climate", "species", "molecule", "theory", "lab", "nasa", "dna")),
    ("Politics", ("government", "president", "election", "policy", "congress",
                  "democrat", "republican", "vote", "law", "legislation", "senate",
                  "political", "campaign", "regulation", "federal", "court", "rights")),
    ("Finance", ("stock", "market", "invest", "bank", "economy", "inflation",
                 "crypto", "bitcoin", "trading", "revenue", "profit", "financial",
                 "dollar", "fund", "debt", "gdp", "tax", "price", "earnings")),
    ("Health", ("health", "medical", "disease", "treatment", "vaccine", "doctor",
                "patient", "hospital", "drug", "mental", "cancer", "therapy",
                "symptom", "diagnosis", "clinical", "virus", "fda", "nutrition")),
    ("Entertainment", ("movie", "game", "music", "show", "film", "series", "album",
                       "artist", "trailer", "release", "review", "stream", "concert",
                       "anime", "gaming", "play", "season", "episode", "actor")),
    ("Education", ("learn", "school", "university", "student", "course", "degree",
                   "education", "teacher", "college", "academic", "study", "exam",
                   "tutor", "curriculum", "lecture", "scholarship")),
    ("World News", ("war", "country", "international", "global", "conflict", "nation",
                    "treaty", "military", "diplomatic", "sanction", "crisis", "refugee",
                    "border", "foreign", "united", "eu", "nato", "trade", "peace")),
)
DEFAULT_TOPIC = "General"

# FIXED VALUES -- image-link rule: URL suffixes (case-insensitive) and host substrings.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp")
IMAGE_DOMAINS = ("i.redd.it", "i.imgur.com", "imgur.com", "preview.redd.it")

# FIXED VALUES -- author values that are never masked, and the permalink host prefix.
UNMASKED_AUTHORS = ("[deleted]", "[removed]", "AutoModerator")
PERMALINK_PREFIX = "https://www.reddit.com"

# FIXED VALUES -- output formats and placeholders.
READABLE_DATE_FORMAT = "MMMM dd, yyyy 'at' hh:mm a 'UTC'"   # strftime "%B %d, %Y at %I:%M %p UTC"
NO_TITLE = "(no title)"
EMPTY_TEXT = "empty"
ELLIPSIS = "…"

# FIXED VALUES -- numeric parameters of the original jobs.
KEYWORDS_PER_POST = 10
TOPICS_PER_POST = 3
KEYWORDS_PER_CLUSTER = 10
KEYWORDS_PER_CLUSTER_REPORT = 8
SAMPLE_TITLES_PER_CLUSTER = 5
SAMPLE_TITLES_PER_CLUSTER_REPORT = 4
SEARCH_SHOWN_POSTS = 15
SEARCH_TITLE_CHARS = 75
SAMPLE_TITLE_CHARS = 80
SUMMARY_TITLE_CHARS = 43
LISTING_CEILING = 1000
KMEANS_SEED = 42
KMEANS_RESTARTS = 10
AUTO_K_RANGE = (2, 10)
SILHOUETTE_SAMPLE = 5000
EXPERIMENT_CLUSTERS = 5
ENCODER_BATCH = 64
INTRA_EPS = 1e-12
COSINE_EPS = 1e-10

# FIXED VALUES -- document-vector configurations (name, dimension, epochs, window, least count).
DOC_VECTOR_CONFIGS = (
    {"name": "doc2vec_50d", "vector_size": 50, "epochs": 30, "min_count": 2, "window": 8},
    {"name": "doc2vec_100d", "vector_size": 100, "epochs": 40, "min_count": 2, "window": 10},
    {"name": "doc2vec_200d", "vector_size": 200, "epochs": 50, "min_count": 2, "window": 10},
)
# Alternating sweeps of the factorisation that can stand in for paragraph vectors (``docvec.doc_vectors_als``).
ALS_SWEEPS = 10
# FIXED VALUES -- word-bin configurations of the comparison (name, dimension, epochs, window, bins).
WORD2VEC_CONFIGS = (
    {"name": "w2v_bins_50d", "vector_size": 50, "epochs": 20, "min_count": 2, "window": 5, "bins": 50},
    {"name": "w2v_bins_100d", "vector_size": 100, "epochs": 25, "min_count": 2, "window": 5, "bins": 100},
    {"name": "w2v_bins_200d", "vector_size": 200, "epochs": 30, "min_count": 2, "window": 5, "bins": 200},
)
