"""Stop-word lists for the content recommender.

The remover's list is the concatenation of Spark's default English list, a
Polish list (one entry per line of the original word file) and four extra
entries; duplicates are harmless.  Two Polish lines hold two tab-separated
words; they are kept whole, so no token can ever match them (quirk Q8).
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Spark ML's default English stop words (StopWordsRemover "english"), in order.
ENGLISH = [
    'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', 'your',
    'yours', 'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', 'her',
    'hers', 'herself', 'it', 'its', 'itself', 'they', 'them', 'their', 'theirs',
    'themselves', 'what', 'which', 'who', 'whom', 'this', 'that', 'these', 'those',
    'am', 'is', 'are', 'was', 'were', 'be', 'been', 'being', 'have', 'has', 'had',
    'having', 'do', 'does', 'did', 'doing', 'a', 'an', 'the', 'and', 'but', 'if', 'or',
    'because', 'as', 'until', 'while', 'of', 'at', 'by', 'for', 'with', 'about',
    'against', 'between', 'into', 'through', 'during', 'before', 'after', 'above',
    'below', 'to', 'from', 'up', 'down', 'in', 'out', 'on', 'off', 'over', 'under',
    'again', 'further', 'then', 'once', 'here', 'there', 'when', 'where', 'why', 'how',
    'all', 'any', 'both', 'each', 'few', 'more', 'most', 'other', 'some', 'such', 'no',
    'nor', 'not', 'only', 'own', 'same', 'so', 'than', 'too', 'very', 's', 't', 'can',
    'will', 'just', 'don', 'should', 'now', "i'll", "you'll", "he'll", "she'll",
    "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm",
    "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've",
    "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't",
    "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", 'cannot', 'could', "here's", "how's", "let's",
    'ought', "that's", "there's", "what's", "when's", "where's", "who's", "why's",
    'would',
]

# Polish stop-word file, one entry per line, in file order.
POLISH = [
    'ach', 'aj', 'albo', 'bardzo', 'bez', 'bo', 'być', 'ci', 'cię', 'ciebie', 'co',
    'czy', 'daleko', 'dla', 'dlaczego', 'dlatego', 'do', 'dobrze', 'dokąd', 'dość',
    'dużo', 'dwa', 'dwaj', 'dwie', 'dwoje', 'dziś', 'dzisiaj', 'gdyby', 'gdzie', 'go',
    'ich', 'ile', 'im', 'inny', 'ja', 'ją', 'jak', 'jakby', 'jaki', 'je', 'jeden',
    'jedna', 'jedno', 'jego', 'jej', 'jemu', 'jeśli', 'jest', 'jestem', 'jeżeli\tjuż',
    'każdy', 'kiedy', 'kierunku', 'kto', 'ku', 'lub', 'ma', 'mają', 'mam', 'mi', 'mną',
    'mnie', 'moi', 'mój', 'moja', 'moje', 'może', 'mu', 'my', 'na', 'nam', 'nami',
    'nas', 'nasi', 'nasz', 'nasza', 'nasze', 'natychmiast', 'nią', 'nic', 'nich',
    'nie', 'niego', 'niej', 'niemu', 'nigdy', 'nim', 'nimi', 'niż', 'obok', 'od',
    'około', 'on', 'ona', 'one', 'oni', 'ono', 'owszem', 'po\tpod', 'ponieważ',
    'przed', 'przedtem', 'są', 'sam', 'sama', 'się', 'skąd', 'tak', 'taki', 'tam',
    'ten', 'to', 'tobą', 'tobie', 'tu', 'tutaj', 'twoi', 'twój', 'twoja', 'twoje',
    'ty', 'wam', 'wami', 'was', 'wasi', 'wasz', 'wasza', 'wasze', 'we', 'więc',
    'wszystko', 'wtedy', 'wy', 'żaden', 'zawsze', 'że', 'z', 'w', 'o', 'x', 'op.',
    'mm', 'mm,',
]

# Entries appended after the two lists.
EXTRA = [" ", "", '"', "-"]
# -----------------------------------------------------------------------------


def reference_stop_words() -> list[str]:
    """English + Polish + extras, concatenated as the reference does."""
    return ENGLISH + POLISH + EXTRA
