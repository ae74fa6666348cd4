"""Words of the checks: the small lexicon plus common words of the test corpus."""

from ..functions.words import LEXICON

# Valences given to common words of the test corpus.
CORPUS_VALENCES = {
    "rewh": 1.5, "orre": -1.2, "thatin": 2.1, "ononst": -2.4, "inoran": 0.6, "hehely": -0.8,
    "orantion": 3.1, "ing": -0.4, "ble": 1.1, "tion": -1.9, "ther": 0.9, "thth": -2.7,
    "thon": 1.3, "than": 0.0, "thnt": -1.6, "thre": 2.2, "thed": -0.9, "thea": 1.8,
    "thou": -2.1, "thing": 0.7, "erin": -1.1, "eron": 2.6, "erhe": -3.0, "eau": 1.4,
    "ment": -1.3, "ier": 0.8, "elle": 2.3, "éque": -2.2, "éai": 1.2, "èle": -0.7,
    "ción": 1.9, "ado": -1.4, "mente": 0.5, "ciónos": -2.6, "ñes": 1.6, "sch": -1.7,
    "ung": 2.0, "ench": -0.6, "heit": 1.7, "keit": -2.3, "lich": 0.4, "ver": -1.5,
}
CHECK_LEXICON = LEXICON | CORPUS_VALENCES

# Word changes over whole texts that bring each rule into play.
EDITS = {
    "basic": [],
    "negation": [(" the ", " not "), (" and ", " isn't "), (" of ", " never so "), (" der ", " nor ")],
    "booster": [(" the ", " very "), (" and ", " sort of "), (" of ", " slightly "), (" de ", " kinda ")],
    "caps": [(" the ", " VERY "), (" and ", " THON "), (" of ", " ERHE "), (" la ", " ELLE "), (" die ", " UNG ")],
    "but": [(" with ", " but "), (" avec ", " BUT "), (" für ", " but "), (" para ", " but ")],
    "punct": [(".\n", "!\n"), (", ", "? "), ("rewh", "(rewh)"), ("thon ", "thon!! "), (" ing", " \"ing")],
    "idioms": [(" the ", " kiss of death "), (" and ", " yeah right "), (" of ", " thon bad ass "),
               (" is ", " just enough "), (" que ", " the bomb eron ")],
    "least": [(" the ", " least "), (" of ", " at "), (" and ", " kind of "), (" der ", " LEAST ")],
}
