"""Rule pack for Latin-script prose (English, French, Spanish, German function words).

It lets every job run on Latin corpora.  Patterns use only syntax that Java and
RE2 read alike (no look-around, no ``\\b``), so results can be checked in SQL.
"""

from __future__ import annotations

from dataclasses import replace

from rootloom.rules.model import (ClaimRule, DiscoursePack, LinePack, Marker, OriginPack,
                                  OriginRule, Profile)

ACCENTED, PLAIN = "àâäáéèêëîïíôöóùûüúçñ", "aaaaeeeeiiiooouuuucn"

PROFILES = {
    "lookup": Profile("*", ACCENTED, PLAIN, lower=True),
    "classify": Profile("*#", ACCENTED, PLAIN, lower=True, collapse=False),
    "classify_v1": Profile("#", ACCENTED, PLAIN, lower=True),
    "graph_term": Profile("*", ACCENTED, PLAIN, lower=True),
    "graph_origin": Profile("*", lower=True),
    "entity": Profile("*.,;:!?|", lower=True, strip_prefix="^the"),
    "initial": Profile("", "éèêàâîôûäöüç", "eeeaaiouaouc", lower=True, collapse=False),
}

LETTERS = "abcdefghijklmnopqrstuvwxyz"
CHAPTER_NAMES = {ch: f"letter {ch}" for ch in LETTERS}
MISSING_INITIALS = ("b", "j", "q", "x")

AUTHORITIES = ("the", "from", "with", "avec", "dans", "para", "nicht", "auf", "des", "los")

ORIGINS = OriginPack(
    name="latin",
    profile=PROFILES["classify"],
    noise=r"\s*\*\s*",
    chains=(
        r"^\p{L}{1,12}(?:\s+(?:and|et|y|und)\s+\p{L}{1,12})*[\s:,.]+([\s\S]{1,400})",
        r"^\P{L}*\p{L}+[\s:,.]+([\s\S]{1,400})",
    ),
    context_prefixes=(r"^(?:a|un|ein)\s+", r"^(?:it|il|es)\s+"),
    rules=(
        OriginRule("no_root", r"^(?:was|fue|war|est)[^\p{L}]", "NO_ROOT_OR_UNCERTAIN", 0),
        OriginRule("uncertain", r"(?:not sure| from | sur | como | nicht )", "UNCERTAIN", None,
                   window=100),
        OriginRule("two", r"^(?:the|la|le|die)\s+([^,.]{3,120})"
                          r"(?:[,.]\s*(?:and|et|y|und)\s+([^,.]{3,120}))?", "MULTI_ORIGIN", 2, (1, 2)),
        OriginRule("three", r"^(?:to|les|los|den)[^:,]{0,50}[,:]?\s*([^,.]{3,120})"
                            r"(?:[,.]\s*(?:the|la|le|die)\s+([^,.]{3,120}))?", "MULTI_ORIGIN", 3, (1, 2)),
        OriginRule("four", r"^(?:in|en|im)[^:,]{0,80}?[,:.\n]\s*([^.,\n]{3,120})", "MULTI_ORIGIN", 4, (1,)),
        OriginRule("single", r"^(?:(?:of|de|von)\s+([^.\n]{3,150})|(?:that|que|der)\s+([^.\n]{3,150}))",
                   "SINGLE_ORIGIN", 1, (1, 2), first_only=True),
        OriginRule("denotes", r"^(?:is|ist|es)\s+([^.\n]{3,150})", "SINGLE_ORIGIN", 1, (1,)),
        OriginRule("word", r"^(?:th\p{L}*)\s+(?:the|of|and)\s+([^.,\n]{3,120})", "SINGLE_WORD", 1, (1,)),
        OriginRule("most", r"^(?:for|pour|para|für)\s+([^.,\n]{3,100})", "SINGLE_ORIGIN", 1, (1,)),
        OriginRule("bare_word", r"^(?:th\p{L}*)(?:\s|[,.:]|$)", "SINGLE_WORD", 1),
        OriginRule("denotes_near", r" (?:with|avec|con|mit)\s+([^.,\n]{3,120})", "SINGLE_ORIGIN", 1,
                   (1,), window=300),
        OriginRule("one_origin", r"^(?:on|au|el|auf)\P{L}", "SINGLE_ORIGIN", 1, (1,),
                   extract=r"(?: by | par | por | bei )([^.,\n]{3,120})", extract_window=400),
    ),
    authorities="|".join(AUTHORITIES),
    ocr_suspect=r"[^\p{L}\p{N}\s_.,:;?!()\[\]\-/*']",
)

_BY_NAME = {r.name: r for r in ORIGINS.rules}
#: The first rule set: no noise stripping, a wider window for doubt, bare words before what most of a root means, no last resort.
ORIGINS_V1 = replace(
    ORIGINS, name="latin_v1", profile=PROFILES["classify_v1"], noise=None, context_prefixes=(), raw_prefix=r"^(?:A|An|Un|Ein)\s+",
    rules=(
        _BY_NAME["no_root"], replace(_BY_NAME["uncertain"], window=120),
        *(_BY_NAME[n] for n in ("two", "three", "four", "single", "denotes")),
        replace(_BY_NAME["bare_word"], groups=(1,), first_only=True, extract=_BY_NAME["word"].pattern),
        _BY_NAME["most"], _BY_NAME["denotes_near"]))

LETTER_NAMES = {"the": "t", "and": "a", "of": "o", "de": "d", "la": "l", "le": "l", "que": "q",
                "der": "r", "die": "i", "und": "u", "el": "e", "is": "s", "to": "t", "en": "n"}
NAMES = "|".join(sorted(LETTER_NAMES, key=len, reverse=True))

LINES = LinePack(
    chapter=r"^(?:In|Im|Un|Den)\s+\p{L}",
    bracket=r"^(\p{L}{1,6})[.]\s*$",
    confirm=rf"(?i)^(?:{NAMES})\s+(?:\p{{L}}+\s+)?(?:{NAMES})",
    strict=rf"(?i)^(?:{NAMES})\s[^\n]{{0,60}}?(?:, | )(?:{NAMES}) ",
    geminate=rf"(?i)^(?:it|this|that|a|un|une|ein|los)\s+(?:\p{{L}}+\s+)?(?:{NAMES})",
    footnote=r"^(?:Be|Was|Est|Ist|Es|By)[\s.]",
    poetry=r"^[^,]{5,}, [^,]{5,}, [^,]{5,}",
    page_ref=r"from (\p{L}+)|by (\p{L}+)",
    page_ref_groups=2,
    letter_names=LETTER_NAMES,
)

END = r"(?:[.,;]|$)"
W = r"\p{L}+"

DISCOURSE = DiscoursePack(
    markers=(
        Marker("is", "USAGE", r" (?:is|est|ist) "),
        Marker("was", "USAGE", r" (?:was|fue|war) "),
        Marker("be", "USAGE", r" (?:be|ser|sein) "),
        Marker("by", "AUTHORITY", rf" (?:by|par|por|von) {W}"),
        Marker("from", "BRANCH", r" (?:from|dans|con|dem) "),
        Marker("this", "INTRO", r" (?:this|une|una|das) "),
        Marker("that", "SECOND_ORIG", r" (?:that|qui|para|sich) "),
        Marker("are", "EXCEPTION", r" (?:are|pas|no|nicht) "),
        Marker("as", "ETYMOLOGY", r" (?:as|sur|como|als) "),
        Marker("an", "ETYMOLOGY", r" (?:an|au|al|ein) "),
        Marker("for", "ETYMOLOGY", r" (?:for|pour|für) "),
        Marker("it", "ETYMOLOGY", r" (?:it|un|lo|im) "),
        Marker("he", "ETYMOLOGY", r" (?:he|et|y|auf) "),
        Marker("on", "ETYMOLOGY", r" (?:on|en|mit) "),
        Marker("with", "HADITH", r" (?:with|avec|se|den) "),
        Marker("at", "PLURAL", r" (?:at|les|los|zu) "),
    ),
    split_order=("are", "that", "from", "this", "with", "is", "was", "be", "by", "it", "for", "on",
                 "as", "an", "he", "at"),
    ocr_fix=(r" teh ", " the "),
    claim_rules=(
        ClaimRule("USAGE", "USAGE_NAMED", rf"(?:is|est|ist|was|be)\s+(?:the|la|die)\s+({W}(?:\s+{W}){{0,2}})", 1, 0),
        ClaimRule("USAGE", "USAGE_CONDITIONAL",
                  rf"(?:is|est|ist|was)\s+([^\n]{{2,30}}?)(?:\s*,\s*|\s+)(?:of|de|der)\s+([^\n]{{5,100}}?){END}", 1, 2),
        ClaimRule("USAGE", "USAGE_FORM", rf"(?:is|was|be)\s+([^\n]{{2,25}}?)\s*,\s*([^\n]{{5,100}}?){END}", 1, 2),
        ClaimRule("USAGE", "USAGE_FORM", rf"(?:is|est|ist|was|be|fue|war|ser|sein)\s+({W}(?:\s+{W}){{0,4}})\s*[.,]", 1, 0),
        ClaimRule("AUTHORITY", "AUTHORITY_CITATION", r"by the\s*[:\s]\s*([\s\S]{5,200})", 0, 1,
                  authority="by the", definition_limit=200, requires="by the"),
        ClaimRule("AUTHORITY", "AUTHORITY_CITATION",
                  rf"(?:by|par|por|von)\s+({W}(?:\s+{W}){{0,2}})\s*[:\s]\s*([\s\S]{{5,200}})", 0, 2,
                  authority=1, definition_limit=200),
        ClaimRule("ETYMOLOGY", "ETYMOLOGY_NAMING",
                  rf"(?:it|un|lo|im)\s+({W}(?:\s+{W}){{0,3}})\s+(?:the|de|der)\s*([^\n]{{5,120}}?){END}", 1, 2),
        ClaimRule("ETYMOLOGY", "ETYMOLOGY_ORIGIN", rf"(?:for|pour|für)\s+([^\n]{{5,120}}?){END}", 0, 1),
        ClaimRule("ETYMOLOGY", "ETYMOLOGY_SEMANTIC", rf"(?:on|en|mit)\s+([^\n]{{5,100}}?){END}", 0, 1),
        ClaimRule("ETYMOLOGY", "ETYMOLOGY_CAUSAL", rf"(?:as|sur|como|als)\s+([^\n]{{5,120}}?){END}", 0, 1),
        ClaimRule("ETYMOLOGY", "ETYMOLOGY_CAUSAL", rf"(?:an|au|al|ein)\s+([^\n]{{5,120}}?){END}", 0, 1),
        ClaimRule("ETYMOLOGY", "ETYMOLOGY_ORIGIN", rf"(?:he|et|y|auf)\s+(?:the\s+)?([^\n]{{5,100}}?){END}", 0, 1),
        ClaimRule("PLURAL", "PLURAL_FORM", rf"(?:at|les|los|zu)\s+({W}(?:\s+(?:and|et|y|und)\s+{W})*)", 1, 0),
        ClaimRule("HADITH", "HADITH_EVIDENCE", r"(?:with|avec|se|den)\s*[:\s]\s*([\s\S]{5,200})", 0, 1,
                  definition_limit=200),
    ),
    authority_trail=r"[,:.;\s]+$",
    anonymous="by the",
    self_markers=("is", "was", "from", "this", "are", "at"),
    hedge=r"(?:^| )(?:an|au|al|ein) ",
    usage_cues=((r"the (?:of|and)|de la", "QURANIC"), (r" (?:to|du|el) ", "POETRY"),
                (r" (?:in|des|del) ", "HADITH")),
    poetry_cue=r" (?:to|du|el) ",
    xref_phrase=r"(?i)(?:see|from|dans|del)\s",
    strength_cues=((r" the (?:of|and) ", "EMPHATIC_ASSERTED"), (r" (?:is|ist) ", "ASSERTED"),
                   (r" (?:as|como) ", "PROBABLE"), (r" (?:was|fue) ", "POSSIBLE"),
                   (r" (?:by|par) ", "REPORTED"), (r" (?:or|ou) ", "DOUBTFUL"),
                   (r" (?:not|nicht|pas) ", "REJECTED")),
    confusions=(("rn", "m"), ("tion", "ti0n"), ("  ", " "), (".,", ","), ("�", "?")),
    script_class=r"\p{L}",
    boundary_probe=" that ",
    boundary_split=r" (?:that|qui|para|sich) ",
    nucleus_rules=(
        rf" (?:for|pour|für)\s+([^\n]{{3,80}}?){END}",
        rf" (?:and|und)\s+([^\n]{{3,80}}?){END}",
        rf" (?:of|de|von)\s+([^\n]{{3,80}}?){END}",
        rf"(?:^|\s)(?:is|est|ist)\s+({W}(?:\s+{W}){{0,4}})",
        rf" (?:to|la|zu)\s+([^\n]{{3,80}}?){END}",
    ),
    first_words=rf"^\P{{L}}*({W}(?:\s+{W}){{0,2}})",
    semantic_kinds=((r"tion", "MOTION_KIND"), (r"ing ", "EVENT_KIND"), (r"(?:ble|lich)", "PROPERTY_KIND"),
                    (r"(?:heit|ment)", "STATE_KIND"), (r" (?:in|en|im) ", "SPATIAL_KIND"),
                    (r" (?:as|als) ", "TEMPORAL_KIND"), (r" (?:les|los) ", "QUANTITY_KIND"),
                    (r" (?:of|de|von) ", "RELATION_KIND"), (r" (?:for|pour|para) ", "FUNCTION_KIND"),
                    (r"eux", "EVALUATIVE_KIND"), (r" (?:the|la|die) ", "ENTITY_KIND")),
    abstraction=((r"ent", "MENTAL_STATE"), (r" and ", "SOCIAL_CONVENTION"), (r" of ", "ABSTRACT_RELATION"),
                 (r"ing", "PHYSICAL_PROCESS"), (r"st", "CONCRETE")),
    temporal=((r" was ", "DURATIVE"), (r" at ", "PUNCTUAL"), (r" be ", "STATIC"), (r" re", "ITERATIVE"),
              (r"ed ", "DYNAMIC"), (r" to ", "RESULT_STATE")),
    relations=((r" as ", "SIMILARITY_EXTENSION"), (r" (?:like|als) ", "METAPHORICAL_EXTENSION"),
               (r" that as ", "SIMILARITY_EXTENSION"), (r" for [^\n]* of ", "NAMING_BY_PROPERTY"),
               (r" it [^\n]* in ", "NAMING_BY_EFFECT"), (r" with ", "INSTRUMENT_OF"),
               (r" and ", "SPECIALIZATION"), (r" (?:in|en) ", "LOCATION_OF"), (r" er", "AGENT_OF"),
               (r" to ", "RESULT_OF"), (r" (?:of|de) ", "PART_OF")),
    distances=((r" like ", "METAPHORICAL"), (r" or ", "METAPHORICAL"), (r" as ", "EXTENDED"),
               (r" of ", "DIRECT")),
    domains=((r"bl", "ANIMAL"), (r"rr", "PLANT"), (r"ha ", "ANATOMY"), (r"tion ", "MOTION"),
             (r"and ", "COLOR"), (r"on ", "SOUND"), (r"th ", "COGNITION"), (r"er ", "LEGAL"),
             (r"es ", "RELIGIOUS"), (r"st ", "ARTIFACT"), (r"ou", "SOCIAL")),
    xref_target=rf"(?:^| )(?:of|to|de|in)\s+(?:(?:the|la|die)\s+)?({W}(?:\s+{W}){{0,2}})",
    event_kinds=((r"tion", "MOTION"), (r" and ", "COMMUNICATION"), (r"ing", "CREATION"),
                 (r"st", "DESTRUCTION"), (r"er ", "TRANSFER")),
    oppositions=((r" not | nicht ", "LEXICAL_ONLY"), (r" are | pas ", "COMPLEMENTARY"),
                 (r" than | que ", "GRADABLE")),
    term_profile=PROFILES["graph_term"],
    origin_profile=PROFILES["graph_origin"],
    entity_profile=PROFILES["entity"],
)

# gate id, kind of test, letters or length, text
GATES = (
    ("G01", "all", "ij", "i/j confusion"), ("G02", "at_least_2", "mnuwv", "stroke letters"),
    ("G03", "all", "ce", "c/e confusion"), ("G04", "all", "rn", "r/n confusion"),
    ("G05", "all", "fs", "f/s confusion"), ("G06", "all", "tl", "t/l confusion"),
    ("G07", "all", "gq", "g/q confusion"), ("G08", "all", "bh", "b/h confusion"),
    ("G09", "at_least_1", "éèêëç", "accented form"), ("G10", "at_least_2", "aeiou", "several vowels"),
    ("G11", "never", "", "reversed letters"), ("G12", "longer", "4", "long root"),
    ("G13", "shorter", "2", "short root"), ("G14", "all", "mn", "m/n confusion"),
    ("G15", "all", "vy", "v/y confusion"), ("G16", "all", "kx", "k/x confusion"),
    ("G17", "all", "sz", "s/z confusion"), ("G18", "distinct_2", "aou", "a/o/u confusion"),
    ("G19", "all", "pq", "p/q confusion"), ("G20", "at_least_1", "'-_", "mark inside root"),
)
