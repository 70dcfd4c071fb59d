"""Fixed values.

Word lists, patterns and cut points that decide results. They are data, kept as plain text in
their natural order; the code that applies them is elsewhere.
"""

# English stop words: Spark's public default list, checked against it in the tests.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()

# ASCII punctuation except the hyphen.
PUNCTUATION = r"[!-,./:-@\[-`{-~]"

# Remnants of HTML, in order: pattern, replacement.
HTML_REMNANTS = [
    ("&nbsp", " "),
    ("nbsp", ""),
    ("&amp", "&"),
    ("/>/Agt/", ""),
    ("</a<gt/", ""),
    ("gt/>", ""),
    ("/>", ""),
    ("<br", ""),
]

# Units of measure, dotted abbreviations, in order: pattern, replacement.
UNITS_DOTTED = [
    ("inches|inch", "in."),
    ("foot|feet|ft", "ft."),
    ("pounds|pound|lbs|lb", "lb."),
    ("square|sq", "sq."),
    ("cubic|cu", "cu."),
    ("gallons|gallon|gal", "gal."),
    ("ounces|ounce|oz", "oz."),
    ("centimeters|cm", "cm."),
    ("milimeters|mm", "mm."),
    ("degrees|degree|°|deg", "deg."),
    ("volts|volt", "volt."),
    ("wattage|watts|watt", "watt."),
    ("ampere|amps|amperes|amp", "amp."),
    ("qquart|quart|qt", "qt."),
    ("gallons per minute|gallon per minute|gal per minute|gallons/min|gallon/min", "gal per min."),
    ("gallons per hour|gallon per hour|gal per hour|gallons/hour|gallon/hour", "gal per hr."),
    ("hrs|hrs.|hours|hour|hr", "hr."),
    ("min|mins.|minutes|minute", "min."),
]

# Units of measure, bare abbreviations, in order: pattern, replacement.
UNITS_BARE = [
    ("foot|feet|ft", "ft"),
    ("pounds|pound|lbs|lb", "lb"),
    ("gallons|gallon", "gal"),
    ("ounces|ounce", "oz"),
    ("centimeters|centimeter", "cm"),
    ("milimeters|milimeter", "mm"),
    ("degrees|degree|°", "deg"),
    ("volts", "volt"),
    ("wattage|watts", "watt"),
    ("ampere|amps|amperes", "amp"),
    ("qquart|quart", "qt"),
    ("gallons per minute|gallon per minute|gal per minute|gallons/min|gallon/min", "gal per min"),
    ("gallons per hour|gallon per hour|gal per hour|gallons/hour|gallon/hour", "gal per hr"),
    ("hrs|hrs.|hours|hour", "hr"),
    ("mins|minutes|minute", "min"),
]

# Relevance cut points, by number of classes.
CUTS_BINARY_LOW = [1.5]
CUTS_BINARY_MID = [2.0]
CUTS_BINARY_HIGH = [2.5]
CUTS_3 = [1.67, 2.5]
CUTS_4 = [1.67, 2.33, 2.67]
CUTS_13 = [1.25, 1.33, 1.5, 1.67, 1.75, 2.0, 2.25, 2.33, 2.5, 2.67, 2.75, 3.0]

# The published Porter (1980) stemmer: suffix, replacement for steps 2 and 3; suffixes of step 4.
PORTER_STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
PORTER_STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
PORTER_STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]
