"""Word lists used as defaults by the cleaning operators.

Fixed values: these must equal the lists the original cleaning step used
for its results to match, so they are written out plainly, in the order
in which their sources publish them.
"""

# The English stop-word list of the NLTK corpus (179 words).
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her",
    "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there",
    "when", "where", "why", "how", "all", "any", "both", "each", "few",
    "more", "most", "other", "some", "such", "no", "nor", "not", "only",
    "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "don't", "should", "should've", "now", "d", "ll", "m",
    "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won",
    "won't", "wouldn", "wouldn't",
]

# ASCII punctuation as in Python's string.punctuation.
PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

# The noun detachment rules of WordNet's morphological
# analyser (suffix, replacement), used by the suffix lemmatiser.
NOUN_SUFFIX_RULES = [
    ("s", ""),
    ("ses", "s"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]

# Irregular noun plurals of English and their singulars.
IRREGULAR_NOUNS = [
    ("axes", "axis"), ("children", "child"), ("crises", "crisis"), ("feet", "foot"), ("geese", "goose"), ("gentlemen", "gentleman"),
    ("indices", "index"), ("knives", "knife"), ("leaves", "leaf"), ("lives", "life"), ("matrices", "matrix"), ("men", "man"),
    ("mice", "mouse"), ("oxen", "ox"), ("people", "person"), ("teeth", "tooth"), ("wives", "wife"), ("women", "woman"),
]
