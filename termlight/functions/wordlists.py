"""Fixed word lists. Every list is the default of a parameter, so callers can pass their own."""

# English function words removed before stemming or lemmatising.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# English words that stand for numbers.
NUMBER_WORDS = """
zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred
thousand million billion trillion quadrillion gajillion bazillion
first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth
fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth thirtieth fortieth
fiftieth sixtieth seventieth eightieth ninetieth hundredth thousandth millionth billionth
trillionth quadrillionth gajillionth bazillionth
""".split()

# Words that never become feedback terms.
FEEDBACK_STOP_WORDS = """
the is in of and to a for on with time current people thing things use used based data information
system
""".split()

# Fused words that the word tokenizer takes apart, and where it cuts them.
FUSED_WORDS = {
    "cannot": "can not",
    "gimme": "gim me",
    "gonna": "gon na",
    "gotta": "got ta",
    "lemme": "lem me",
    "wanna": "wan na",
}

# Words that turn the valence of one of the next three words around.
NEGATORS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't
doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't
mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt
uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't
wouldn't rarely seldom despite
""".split()
