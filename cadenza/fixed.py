"""Fixed values.

These values must equal the ones of the original pipeline for results to
match; they are data, so every operator takes them as a parameter with
these as defaults.
"""

# --- fixed values: major-genre vocabulary, in tie-break order ---------------
GENRE_LABELS = [
    "country", "electronic", "funk", "hip hop", "jazz", "rap", "classical",
    "dance", "soul", "indie", "latin", "pop", "punk", "reggae", "rock",
    "metal", "r&b", "house", "techno", "folk",
]

# --- fixed values: link hosts that mark a song recommendation ----------------
LINK_TERMS = ["youtu", "spotify", "soundcloud", "bandcamp"]

# --- fixed values: title separator, similarity threshold, pair threshold -----
TITLE_SEPARATOR = " - "
MATCH_THRESHOLD = 0.7
PAIR_THRESHOLD = 1.4
CANDIDATES_PER_POST = 10
POSTS_PER_PULL = 100

# --- fixed values: feeds, in processing order, with their rules ---------------
# (ord, feed, flair rule, flair values, tags removed from the title)
# flair rule: "ne"  = flair must differ from the value (missing passes)
#             "in"  = flair must be one of the values (missing fails)
#             "nin" = flair must not be one of the values (missing passes)
#             None  = no flair rule
FEED_RULES = [
    (1, "Music", "ne", ["i made this"], []),
    (2, "indieheads", None, [], ["[FRESH]", "[FRESH VIDEO]", "[FRESH ALBUM]", "[ORIGINAL]"]),
    (3, "popheads", "in", ["[PERFORMANCE]", "[FRESH]", "[FRESH VIDEO]"], []),
    (4, "electronicmusic", "nin", ["Discussion", "AMA Announcement"], []),
]
PERMALINK_PREFIX = "https://www.reddit.com/r/{feed}/comments/"
TRACK_LINK_PREFIX = "https://open.spotify.com/track/"

# --- fixed values: preference label -> uniform range (lo, hi) -----------------
# value used when a dimension is not chosen ('')
NOT_CHOSEN = 0.5
PREFERENCE_BUCKETS = {
    "danceability": [("Not Danceable", 0.0, 0.3), ("Rhythmic", 0.3, 0.6),
                     ("Perfect For Dancing", 0.6, 1.0)],
    "energy": [("Calm", 0.0, 0.3), ("Quite Exciting", 0.3, 0.6),
               ("Extremely Exciting", 0.6, 1.0)],
    "loudness": [("Soft", -5.0, 0.0), ("Average Loudness", -10.0, -5.0),
                 ("Very Loud", -20.0, -10.0)],
    "instrumentalness": [("No", 0.0, 0.5), ("Yes", 0.5, 1.0)],
    "valence": [("Highly Negative", 0.0, 0.2), ("Negative", 0.2, 0.4),
                ("Balanced", 0.4, 0.6), ("Positive", 0.6, 0.8),
                ("Highly Positive", 0.8, 1.0)],
}
# default numeric request of the scoring API
DEFAULT_REQUEST = {"danceability": 0.5, "energy": 0.5, "loudness": -10.1,
                   "instrumentalness": 0.5, "valence": 0.5}

# --- fixed values: recommender -----------------------------------------------
FEATURE_COLUMNS = ["danceability", "energy", "loudness", "instrumentalness", "valence"]
KMEANS_K = 5
KMEANS_SEED = 3
K_SWEEP = list(range(2, 10))
TOP_IN_CLUSTER = 10
RECOMMENDATIONS = 5

# --- fixed values: lake schema column order ------------------------------------
LAKE_COLUMNS = [
    ("post_id", "string"), ("post_created_utc", "string"), ("post_title", "string"),
    ("post_url", "string"), ("artists_id", "string"), ("artists_name", "string"),
    ("track_id", "string"), ("track_name", "string"), ("release_date", "string"),
    ("genres", "string"), ("track_popularity", "int"), ("danceability", "float"),
    ("energy", "float"), ("key", "int"), ("mode", "string"), ("loudness", "float"),
    ("speechiness", "float"), ("acousticness", "float"), ("instrumentalness", "float"),
    ("liveness", "float"), ("valence", "float"), ("tempo", "float"),
    ("duration_ms", "int"), ("time_signature", "int"),
]
# columns the recommender does not use
RECOMMENDER_DROP = ["post_id", "post_created_utc", "post_title", "post_url", "key", "mode",
                    "speechiness", "acousticness", "liveness", "tempo", "time_signature",
                    "year", "month", "day"]

# --- fixed values: daily report columns, and the averaged column behind each ---------
REPORT_COLUMNS = ["Genre", "NumberOfSongs", "Popularity", "Danceability", "Energy",
                  "Valence", "Loudness", "year", "month", "day"]
AVG_COLUMNS = {"track_popularity": "Popularity", "danceability": "Danceability",
               "energy": "Energy", "valence": "Valence", "loudness": "Loudness"}
