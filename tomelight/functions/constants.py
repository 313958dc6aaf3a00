"""Word lists, taxonomies and templates results depend on."""

# The 179 English stop words removed from tokens and lemmas.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Phrases that open a line-spanning boilerplate run, each cut up
# to the next "valve <number>".
BOILERPLATE = ["Hydraulic system", "Functions and operation"]

# Intents in matching order, with their descriptions.
INTENTS = {
    "how_to": "The user asks for step-by-step instructions or procedures.",
    "spec_query": "The user asks for technical specifications, measurements, or values.",
    "diagnose": "The user reports a problem, symptom, or error code and seeks diagnosis.",
    "safety_check": "The user asks about risks, precautions, permissions, or safety conditions.",
    "summary": "The user asks for a summary of the manual",
    "other": "None of the above.",
}

# The classification prompt.
PROMPT_TEMPLATE = """You are a technical support assistant for manuals. Classify the user's question into exactly ONE of these intents:

    {intent_descriptions}

    Question: "{question}"
    Intent (one word only):

    Here are some examples: "{examples}"
    """

# The labelled questions used as the built-in test set.
TEST_QUESTIONS = {
    "how_to": [
        "How do I reset the thermostat?",
        "What are the steps to replace the battery?",
        "How to calibrate the sensor?",
        "Instructions for installing the firmware update.",
        "How do I pair the device with my phone?",
        "What is the procedure to clean the filter?",
        "How to enter diagnostic mode?",
        "Steps to mount the bracket on the wall.",
    ],
    "spec_query": [
        "What is the maximum voltage?",
        "Weight of model X200?",
        "What are the dimensions of the unit?",
        "Input frequency range?",
        "Is the operating temperature -10°C to 50°C?",
        "What is the IP rating?",
        "Power consumption in standby mode?",
    ],
    "diagnose": [
        "Why won't the device turn on?",
        "What does error code E12 mean?",
        "The screen is flashing red. What should I do?",
        "Device overheats after 5 minutes. Help?",
        "Error ERR-404 appears on startup.",
        "No response when pressing buttons.",
        "Water leak from bottom panel.",
        "Intermittent Wi-Fi connection.",
    ],
    "safety_check": [
        "Is it safe to open the cover while powered?",
        "Do I need to wear gloves for this procedure?",
        "Can this device be used in a bathroom?",
        "Is grounding required?",
        "Are there any radiation hazards?",
        "Can children operate this machine?",
        "Is it fire-resistant?",
    ],
}

# Flags a chunk carries for re-ranking.
WARNING_PATTERN = "⚠|WARNING|CAUTION|DANGER"
TABLE_LITERAL = r":\s*\d"

# Default search scope labels.
SCOPE_ALL = "toda la base de conocimiento"
SCOPE_ONE = "documento '{}'"
STATS_SCOPE_ALL = "base de conocimiento completa"
