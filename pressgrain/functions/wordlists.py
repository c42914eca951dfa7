"""Word lists.  The long English stop-word list is Spark's own (a parameter)."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover

# Words added to the stop list for classification and topics.
REPORTING_VERBS = ["like", "said", "says"]

# Further words added for keyword extraction.
FILLERS = [
    "actually", "probably", "maybe", "perhaps", "really",
    "just", "quite", "simply", "so", "very",
]

# Title keywords that exclude an article from the corpus.
EXCLUDED_TITLE_KEYWORDS = [
    "Israel", "Israeli", "Netanyahu", "Gaza", "Hamas", "UNRWA", "Pakistan",
    "Rafah", "Rohingya", "Burma", "Myanmar", "Syria", "Jew", "Holocaust",
]

# Topics searched for, terms joined by AND.
TOPICS = [
    "refugees", "immigration AND policy", "border security", "asylum seekers",
    "migrant workers", "immigrant rights", "deportation AND policy",
    "undocumented immigrants", "refugee camps", "human trafficking",
    "immigration reform", "visa policy", "sanctuary cities",
    "integration AND immigrants", "cross-border movement", "climate refugees",
    "family reunification", "labor market integration",
    "anti-immigration policies", "refugee education", "migration and health",
    "border technology", "international asylum laws",
    "immigrant detention centers", "cultural integration",
]

# Outlets looked up in the source catalogue.
OUTLETS = [
    "Al Jazeera English", "BBC News", "Bloomberg", "Breitbart News", "CNN",
    "Chicago Tribune", "Financial Times", "Fox News", "Los Angeles Times",
    "NPR", "Politico", "Reuters", "The American Conservative", "The Atlantic",
    "The Boston Globe", "The Daily Wire", "The Economist", "The Federalist",
    "The Guardian", "The National Review", "The New York Post",
    "The New York Times", "The New Yorker", "The Wall Street Journal",
    "The Washington Examiner", "The Washington Post", "Time",
    "The Huffington Post", "Mother Jones", "The Intercept", "Jacobin",
    "Democracy Now!", "Salon", "Slate", "ThinkProgress", "The Nation", "Vox",
]

# Editorial stance per outlet, in catalogue order.
EDITORIAL_STANCES = {
    "Aljazeera": "Mainstream",
    "BBC": "Mainstream",
    "Bloomberg": "Mainstream",
    "Breitbart": "MAGA",
    "Cnn": "Mainstream",
    "Chicago Tribune": "Mainstream",
    "Financial Times": "Mainstream",
    "Foxnews": "MAGA",
    "Los Angeles Times": "Mainstream",
    "NPR": "Mainstream",
    "Politico": "Mainstream",
    "Reuters": "Agnostic",
    "The American Conservative": "Conservative",
    "The Atlantic": "Progressive",
    "The Boston Globe": "Mainstream",
    "The Daily Wire": "MAGA",
    "The Economist": "Mainstream",
    "The Federalist": "MAGA",
    "The Guardian": "Progressive",
    "The National Review": "Conservative",
    "The New York Post": "MAGA",
    "The New York Times": "Mainstream",
    "Nymag": "Mainstream",
    "The Wall Street Journal": "Mainstream",
    "The Washington Examiner": "MAGA",
    "TWashingtonpost": "Mainstream",
    "Time": "Mainstream",
    "The Huffington Post": "Progressive",
    "Mother Jones": "Progressive",
    "The Intercept": "Progressive",
    "Jacobin": "Progressive",
    "Democracy Now!": "Progressive",
    "Salon": "Progressive",
    "Slate": "Progressive",
    "ThinkProgress": "Progressive",
    "The Nation": "Progressive",
    "Vox": "Progressive",
}

# Audience per publisher in millions.
FOLLOWERS_MILLIONS = {
    "Bbc": 2.3,
    "Aljazeera": 8.8,
    "Time": 19.3,
    "Politico": 4.6,
    "Nymag": 1.7,
    "Cnn": 62.2,
    "Washingtonpost": 20.0,
    "Breitbart": 2.0,
    "Foxnews": 24.4,
}


def english_stop_words(extra: list[str] | tuple[str, ...] = ()) -> list[str]:
    """Spark's English list plus ``extra``; needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english") + list(extra)
