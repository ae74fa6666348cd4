"""Word tables used when the caller brings none of their own.

The rule words and constants below belong to the published VADER model (Hutto
and Gilbert, ICWSM 2014). The opinion lexicon, the stop words and the glossary
are small lists of this package; a caller replaces them with a table of any size.
"""

# Weights of the published model.
BOOST = 0.293
CAPS = 0.733
NEGATE = -0.74
DECAY = (1.0, 0.95, 0.9)
EXCLAMATION = 0.292
QUESTION = 0.18
QUESTION_MANY = 0.96
ALPHA = 15.0

# Words that strengthen the word after them.
STRENGTHENERS = """
absolutely amazingly awfully completely considerably decidedly deeply effing
enormously entirely especially exceptionally extremely fabulously flipping
flippin fricking frickin frigging friggin fully fucking greatly hella highly
hugely incredibly intensely majorly more most particularly purely quite really
remarkably so substantially thoroughly totally tremendously uber unbelievably
unusually utterly very
""".split()

# Words that weaken the word after them.
WEAKENERS = """
almost barely hardly kinda kindof kind-of less little marginally occasionally
partly scarcely slightly somewhat sorta sortof sort-of
""".split()

# Weakening expressions of two words.
WEAKENING_PAIRS = ["just enough", "kind of", "sort of"]

# Words that turn the sign of the words after them.
NEGATORS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't
daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't
hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor
not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't
shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom
despite
""".split()

# Expressions with a valence of their own.
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# Punctuation taken off one end of a word.
EDGE_PUNCTUATION = [
    ".", "!", "?", ",", ";", ":", "-", "'", '"',
    "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?",
]

BOOSTERS = {w: BOOST for w in STRENGTHENERS} | {w: -BOOST for w in WEAKENERS + WEAKENING_PAIRS}


def _table(text):
    return {w: float(v) for w, v in (line.split() for line in text.strip().splitlines())}


# This package's own small opinion lexicon (valence from -4 to 4).
LEXICON = _table("""
amazing 3.0
awesome 3.1
beautiful 2.8
best 3.2
better 1.9
brilliant 2.9
calm 1.3
clean 1.6
comfortable 2.0
delicious 2.7
delight 2.8
easy 1.7
enjoy 2.2
excellent 3.0
fantastic 2.8
fast 1.1
favorite 2.1
fine 0.9
free 1.2
fresh 1.4
friendly 2.2
fun 2.3
glad 2.0
good 1.9
great 3.1
happy 2.7
helpful 1.9
honest 2.1
kind 2.2
like 1.5
love 3.2
lovely 2.8
nice 1.8
perfect 2.9
pleasant 2.3
polite 1.8
quick 1.0
recommend 1.7
reliable 1.8
satisfied 1.9
smart 1.7
thanks 1.9
useful 1.8
welcome 1.9
wonderful 2.8
:) 2.0
:-) 1.6
:( -1.9
:-( -1.6
angry -2.3
annoying -1.9
awful -2.1
bad -2.5
boring -1.4
broken -1.9
cold -0.6
complaint -1.4
damaged -1.9
delay -1.2
dirty -1.9
disappointed -2.0
disgusting -2.5
expensive -0.9
fail -2.4
fraud -2.8
hate -2.8
horrible -2.6
idiot -2.3
late -0.8
loser -2.4
lost -1.2
moron -2.2
never-again -2.2
noisy -1.1
poor -2.0
problem -1.7
rude -2.1
sad -2.1
scam -2.7
slow -1.0
stupid -2.4
terrible -2.3
trash -1.8
ugly -2.3
unhappy -1.9
useless -1.8
waste -1.8
worse -2.1
worst -3.0
worthless -2.1
wrong -2.0
""")

# This package's own stop words, by language.
STOP_WORDS = {
    "en": "the and of to in is that was for it with as on be at by are this from have or an they which you".split(),
    "fr": "le la les des du un une et est que qui dans pour sur avec pas au ce il elle ne se sont plus par".split(),
    "es": "el la los las de que y en un una es por con para del se no su al lo como más pero sus le".split(),
    "de": "der die das und ist nicht ein eine zu den von mit sich auf für dem im es auch an als wie sie bei oder".split(),
}

# This package's own glossary: language -> word -> English.
GLOSSARY = {
    "fr": {
        "le": "the", "la": "the", "les": "the", "et": "and", "est": "is", "un": "a", "une": "a",
        "avec": "with", "pour": "for", "pas": "not", "très": "very", "mais": "but", "jamais": "never",
        "bon": "good", "bonne": "good", "mauvais": "bad", "mauvaise": "bad", "meilleur": "best",
        "terrible": "terrible", "horrible": "horrible", "merci": "thanks", "problème": "problem",
        "service": "service", "triste": "sad", "heureux": "happy", "lent": "slow", "cher": "expensive",
        "dans": "in", "sur": "on", "que": "that", "qui": "who", "des": "some", "du": "of", "de": "of",
        "en": "in", "plus": "more",
    },
    "es": {
        "el": "the", "la": "the", "los": "the", "las": "the", "y": "and", "es": "is", "un": "a",
        "una": "a", "con": "with", "para": "for", "no": "not", "muy": "very", "pero": "but",
        "nunca": "never", "bueno": "good", "buena": "good", "malo": "bad", "mala": "bad",
        "mejor": "best", "peor": "worst", "gracias": "thanks", "problema": "problem",
        "servicio": "service", "triste": "sad", "feliz": "happy", "lento": "slow", "caro": "expensive",
        "en": "in", "que": "that", "de": "of", "del": "of", "por": "by", "se": "itself", "al": "to",
        "como": "like", "más": "more",
    },
    "de": {
        "der": "the", "die": "the", "das": "the", "und": "and", "ist": "is", "ein": "a", "eine": "a",
        "mit": "with", "für": "for", "nicht": "not", "sehr": "very", "aber": "but", "nie": "never",
        "gut": "good", "gute": "good", "schlecht": "bad", "schlechte": "bad", "beste": "best",
        "schrecklich": "terrible", "danke": "thanks", "problem": "problem", "dienst": "service",
        "traurig": "sad", "glücklich": "happy", "langsam": "slow", "teuer": "expensive",
        "in": "in", "von": "of", "zu": "to", "den": "the", "dem": "the", "auf": "on", "sich": "itself",
        "auch": "also", "als": "as", "wie": "like",
    },
}
