"""Arabic rule pack.

Fixed values: the word lists, letter tables, patterns and labels below decide the
results, so they are stated as they are, in their order of precedence.
"""

from __future__ import annotations

from rootloom.rules.model import (ClaimRule, DiscoursePack, LinePack, Marker,
                                  OriginPack, OriginRule, Profile, java_regex as J)

# ---------------------------------------------------------------- fixed values
SHORT_MARKS = "".join(map(chr, range(0x064B, 0x0653)))
LONG_MARKS = "".join(map(chr, range(0x064B, 0x0660)))
ENTITY_MARKS = "ًٌٍَُِّْٰٕٟٓٔ"

PROFILES = {
    "lookup": Profile(SHORT_MARKS + "ٰٱ", "أإآىة", "ااايه"),
    "classify": Profile(SHORT_MARKS + "ٰٱ", "أإآىؤئ", "ااايوي", collapse=False),
    "classify_v1": Profile(SHORT_MARKS + "ٰٱ", "أإآى", "اااي", collapse=False),
    "marks_only": Profile(SHORT_MARKS + "ٰٱ", collapse=False),
    "graph_term": Profile(LONG_MARKS + "ٰ", "أإآة", "اااه"),
    "graph_origin": Profile(LONG_MARKS + "ٰ", "أإآ", "ااا"),
    "entity": Profile(ENTITY_MARKS, strip_prefix="^ال"),
    "hamza": Profile("", "أإآء", "اااا", collapse=False),
}

CHAPTER_NAMES = {
    "ا": "الألف", "أ": "الألف", "إ": "الألف", "آ": "الألف", "ء": "الألف",
    "ب": "الباء", "ت": "التاء", "ة": "التاء", "ث": "الثاء", "ج": "الجيم",
    "ح": "الحاء", "خ": "الخاء", "د": "الدال", "ذ": "الذال", "ر": "الراء",
    "ز": "الزاي", "س": "السين", "ش": "الشين", "ص": "الصاد", "ض": "الضاد",
    "ط": "الطاء", "ظ": "الظاء", "ع": "العين", "غ": "الغين", "ف": "الفاء",
    "ق": "القاف", "ك": "الكاف", "ل": "اللام", "م": "الميم", "ن": "النون",
    "ه": "الهاء", "و": "الواو", "ؤ": "الواو", "ي": "الياء", "ئ": "الياء",
}

LETTER_NAMES = {
    "الهمزة": "أ", "الألف": "أ", "الباء": "ب", "التاء": "ت", "الثاء": "ث",
    "الجيم": "ج", "الحاء": "ح", "الخاء": "خ", "الدال": "د", "الذال": "ذ",
    "الراء": "ر", "الزاء": "ز", "الزاي": "ز", "السين": "س", "الشين": "ش",
    "الصاد": "ص", "الضاد": "ض", "الطاء": "ط", "الظاء": "ظ", "العين": "ع",
    "الغين": "غ", "الفاء": "ف", "القاف": "ق", "الكاف": "ك", "اللام": "ل",
    "الميم": "م", "النون": "ن", "الهاء": "ه", "الواو": "و", "الياء": "ي",
}

MISSING_INITIALS = ("ا", "ب", "ت", "ث", "ج")

AUTHORITIES = (
    "الخليل", "ابن دريد", "أبو عبيدة", "الأصمعي", "أبو زيد",
    "الفراء", "ابن الأعرابي", "سيبويه", "المبرد", "ثعلب",
    "قطرب", "الكسائي", "أبو عمرو", "الليث", "الجوهري",
    "أبو بكر", "ابن السكيت", "أبو عمر", "ابن قتيبة",
)

OCR_SUSPECT = r"[^؀-ۿ\s\p{L}\p{N}_،.:؟!()«»\[\]\-/*]"

# Letter-name chain that opens an entry, and what follows it.
CHAIN_V2 = r"(?:ال\w{2,6}(?:\s+و(?:ال)?\w{2,6})*(?:\s+و(?:ال)?(?:حرف\s+)?المعتل)?)"
GAP_V2 = r"(?:\s+ف(?:له\s+|لها\s+|لهما\s+)|[\s:،.]+)"
CHAIN_V1 = r"(?:ال\w{2,6}(?:\s+و(?:ال)?\w{2,6})*(?:\s+والحرف\s+المعتل?)?)"
GAP_V1 = r"[\s:،.]+"

BARE_WORD_V2 = r"^(?:\*?\s*)?كلمة\s*(?:واحدة)?(?:\s|[،.:]|$)"
BARE_WORD_V1 = r"^(?:\*?\s*)?كلمة\s*(?:واحدة)?"
DENOTES_ANYWHERE = r"يدل[ُّ]?\s+علي?\s+([^.،\n]{3,120})"
ONE_ORIGIN = r"^اصل\s+واحد|^قياس\s+واحد"
ONE_ORIGIN_TEXT = r"(?:فالاصل\s+|فهو\s+|وهو\s+|وهي\s+|والمعني\s+)([^.،\n]{3,120})"

ORIGIN_PATTERNS_V2 = {
    "no_root": (
        r"^(?:كلمة\s+ان\s+صحت|ليست?\s+(?:باصل|في\s+هذا|اصلا|بعربية|عربية)|"
        r"فليس\s+باصل|ليس\s+له\s+اصل|لا\s+اصل\s+له|فرع\s+(?:ليس|لا)|"
        r"ليس\s+(?:باصل|اصلا|بشئ)(?:\s+(?:ولا|الا|و)|$))"),
    "uncertain": r"(?:فيها?\s+نظر|امر\s+مشكل|لا\s+اعرف\s+له\s+اصلا)",
    "two": (
        r"^(?:ف?اصلان|ف?معنيان|وجهان|كلمتان|له\s+معنيان|له\s+اصلان|لها\s+اصلان)"
        r"\s*[^:،.]{0,30}?[،:\s]\s*"
        r"(?:احدهما|الاول|احد\s+المعنيين|\[احدهما\])?\s*([^،.]{3,120})"
        r"(?:[،.]\s*(?:والاخر|والثاني|والثانى|الاخر|والمعني\s+الاخر|والكلمة\s+الاخري)\s+([^،.]{3,120}))?"),
    "three": (
        r"^(?:ثلاثة\s+اصول?|اصول?\s+ثلاثة|كلمات\s+ثلاث|له?\s+ثلاثة\s+اصول?|"
        r"بناء\s+علي\s+اصول\s+ثلاثة|علي\s+اصول\s+ثلاثة|علي\s+ثلاثة\s+اصول?)[^:،]{0,50}[،:]?\s*"
        r"(?:\[علي\]\s+)?(?:الاولي?\s+|الاول\s+)?([^،.]{3,120})"
        r"(?:[،.]\s*(?:والثاني?|الثاني?|والاخري?)\s+([^،.]{3,120}))?"),
    "four": (
        r"^(?:اصول?\s+اربعة|اربعة\s+اصول?|لها\s+اربعة\s+اصول?)[^:،]{0,80}?[،:.\n]\s*"
        r"(?:فالاول|الاول|احدها|وهي)\s*[:\s]\s*([^.،\n]{3,120})"),
    "single": (
        r"^(?:\*?\s*)?(?:في\s+المضاعف\s+|قريب\s+من\s+\w+\s+)?"
        r"(?:اصيل\s+(?:يدل|تدل)\s+علي?\s+([^.\n]{3,150})|"
        r"(?:ف?اصيل?|ف?اصل\s+(?:واحد|صحيح|مطرد|[^،:]{0,30})?|قياس\s+واحد\s+و?اصل\s+(?:واحد)?)"
        r"(?:[^،:.]{0,80}?)(?:(?:،|:|\.)\s*\n?\s*"
        r"(?:وهو|وهي|وهى|يدل\s+علي?|تدل\s+علي?|فال\w+\s*:\s*|فالمعني\s+)\s*([^.\n]{3,150})))"),
    "denotes": r"^(?:\*?\s*)?(?:يدل|تدل)(?:\s+بناوها?)?\s+علي?\s+([^.\n]{3,150})",
    "word": r"^كلمة\s*(?:واحدة)?\s+(?:تدل|يدل)\s+علي?\s+([^.،\n]{3,120})",
    "most": r"^معظم\s+بابه\s+([^.،\n]{3,100})",
}

ORIGIN_PATTERNS_V1 = {
    "no_root": (
        r"^(?:\*\s*)?(?:كلمة\s+ان\s+صحت|ليست?\s+(?:باصل|بشئ|في\s+هذا|بذات\s+وجهين)|"
        r"فليس\s+(?:باصل|بشئ|له\s+اصل)|ليس\s+له\s+اصل|لا\s+اصل\s+له|"
        r"ليس\s+(?:باصل|اصلا|بشئ)(?:\s+(?:ولا|الا|و)|$)|لا\s+اصل\s+ولا\s+فرع|"
        r"ليس\s+فيه\s+الا\s+\w+|ليس\s+في\s+هذا\s+الباب)"),
    "uncertain": r"(?:فيها?\s+نظر|فيه\s+نظر|امر\s+مشكل|لا\s+اعرف\s+له\s+اصلا)",
    "two": (
        r"^(?:\*?\s*)?(?:ف?اصلان|ف?معنيان|وجهان|كلمتان)\s*[^:،.]{0,30}?[،:\s]\s*"
        r"(?:احدهما|الاول|احد\s+المعنيين|\[احدهما\])?\s*([^،.]{3,120})"
        r"(?:[،.]\s*(?:والاخر|والثاني|والثانى|الاخر|والمعني\s+الاخر|والكلمة\s+الاخري)\s+([^،.]{3,120}))?"),
    "three": (
        r"^(?:\*?\s*)?(?:ثلاثة\s+اصول?|اصول?\s+ثلاثة|كلمات\s+ثلاث)[^:،]{0,50}[،:]?\s*"
        r"(?:الاولي?\s+)?([^،.]{3,120})"
        r"(?:[،.]\s*(?:والثاني?|الثاني?|والاخري?)\s+([^،.]{3,120}))?"),
    "four": (
        r"^(?:\*?\s*)?(?:اصول?\s+اربعة|اربعة\s+اصول?)[^:،]{0,80}?[،:.\n]\s*"
        r"(?:فالاول|الاول|احدها)\s*[:\s]\s*([^.،\n]{3,120})"),
    "single": (
        r"^(?:\*?\s*)?(?:في\s+المضاعف\s+|قريب\s+من\s+\w+\s+)?"
        r"(?:اصيل\s+(?:يدل|تدل)\s+علي?\s+([^.\n]{3,150})|"
        r"(?:اصيل?|اصل\s+(?:واحد|صحيح|مطرد|[^،:]{0,30})?)(?:[^،:.]{0,50}?)"
        r"(?:(?:،|:|\.)\s*\n?\s*(?:وهو|وهي|وهى|يدل\s+علي?|تدل\s+علي?|فال\w+\s*:\s*|فالمعني\s+)"
        r"\s*([^.\n]{3,150})))"),
    "denotes": r"^(?:\*?\s*)?(?:يدل|تدل)(?:\s+بناوها?)?\s+علي?\s+([^.\n]{3,150})",
    "word": (
        r"^(?:\*?\s*)?كلمة\s*(?:واحدة)?\s*(?:(?:تدل|يدل)\s+علي?\s+([^.،\n]{3,120})"
        r"|(?:[،.]\s*(?:وهو|وهي|وهى)\s+([^.،\n]{3,120})))"),
    "most": r"^(?:\*?\s*)?معظم\s+بابه\s+([^.،\n]{3,100})",
}

MARKERS = (
    ("يقال", "USAGE", r"(?:و|ف)?(?:ي|ب)قال\b|(?:و)?يُقال\b|فيقال\b"),
    ("يقولون", "USAGE", r"(?:و)?يقولون\b|(?:و)?تقول\b"),
    ("قيل", "USAGE", r"\bقيل\b"),
    ("قال", "AUTHORITY", r"(?:و)?قال\s+[؀-ۿ\p{L}\p{N}_]+|قالوا\b"),
    ("ومن الباب", "BRANCH", r"ومن (?:هذا )?(?:الباب|الأصل)\b"),
    ("من ذلك", "INTRO", r"(?:ف)?من ذلك\b|وذلك\b"),
    ("والأصل الآخر", "SECOND_ORIG",
     r"(?:و)?(?:الأصل|والأصل) (?:الآخر|الثانى|الثاني)\b|فالأوَّل\b|فالأول\b"),
    ("ومما شذّ", "EXCEPTION", r"ومما شذَّ?(?:\s+عن\s+الباب)?"),
    ("أصله", "ETYMOLOGY", r"\bأصل(?:ه|ها|هُ|ان)\b"),
    ("لأنّه", "ETYMOLOGY", r"\bلأنَّ?ه\b"),
    ("كأنّه", "ETYMOLOGY", r"\bكأنَّ?ه\b"),
    ("سمّي", "ETYMOLOGY", r"\bسُمِّي(?:ت)?\b|سمِّي(?:ت)?\b|(?:وإنما\s+)?تسميت?هم\b"),
    ("اشتقاقه", "ETYMOLOGY", r"\bاشتقاق(?:ه|ها)?\b|\bمشتق\b"),
    ("يدلّ على", "ETYMOLOGY", r"\bيدلُّ? على\b"),
    ("الحديث", "HADITH", r"(?:و)?(?:فى|في)\s+الحديث\b"),
    ("والجمع", "PLURAL", r"(?:و)?(?:الجمع|جمعه)\b"),
)

SPLIT_ORDER = (
    "ومما شذّ", "والأصل الآخر", "ومن الباب", "من ذلك", "الحديث", "يقال", "يقولون",
    "قيل", "قال", "سمّي", "أصله", "يدلّ على", "لأنّه", "كأنّه", "اشتقاقه", "والجمع",
)

AR = r"[؀-ۿ]"

# segment type, claim type, pattern, term group, definition group
CLAIM_PATTERNS = (
    ("USAGE", "USAGE_NAMED", rf"(?:و|ف)?(?:ي|ب)قال\s+له\s+({AR}+(?:\s+{AR}+){{0,2}})", 1, 0),
    ("USAGE", "USAGE_CONDITIONAL",
     r"(?:و|ف)?(?:ي|ب)قال\s+(.{2,30}?)(?:\s*،\s*|\s+)إذا\s+(.{5,100}?)(?:[.،؛]|$)", 1, 2),
    ("USAGE", "USAGE_FORM", r"(?:و|ف)?(?:ي|ب)قال\s+(.{2,25}?)\s*:\s*(.{5,100}?)(?:[.،؛]|$)", 1, 2),
    ("USAGE", "USAGE_FORM", rf"(?:و|ف)?(?:ي|ب)قال\s+({AR}+(?:\s+{AR}+){{0,4}})\s*[.،]", 1, 0),
    ("ETYMOLOGY", "ETYMOLOGY_NAMING",
     rf"سُمِّي(?:ت)?\s+({AR}+(?:\s+{AR}+){{0,3}})\s+(?:لأنَّ?|لأنه|ل)\s*(.{{5,120}}?)(?:[.،؛]|$)", 1, 2),
    ("ETYMOLOGY", "ETYMOLOGY_ORIGIN", r"أصل(?:ه|ها|هُ|ان)\s+(.{5,120}?)(?:[.،؛]|$)", 0, 1),
    ("ETYMOLOGY", "ETYMOLOGY_SEMANTIC", r"يدلُّ? على\s+(.{5,100}?)(?:[.،؛]|$)", 0, 1),
    ("ETYMOLOGY", "ETYMOLOGY_CAUSAL", r"لأنَّ?ه\s+(.{5,120}?)(?:[.،؛]|$)", 0, 1),
    ("ETYMOLOGY", "ETYMOLOGY_CAUSAL", r"كأنَّ?ه\s+(.{5,120}?)(?:[.،؛]|$)", 0, 1),
    ("ETYMOLOGY", "ETYMOLOGY_ORIGIN",
     r"(?:اشتقاق(?:ه|ها)?|مشتق)\s+(?:من\s+)?(.{5,100}?)(?:[.،؛]|$)", 0, 1),
    ("PLURAL", "PLURAL_FORM", rf"(?:و)?(?:الجمع|جمعه)\s+({AR}+(?:\s+(?:و|أو)\s+{AR}+)*)", 1, 0),
)
ANONYMOUS = "قالوا"
ANONYMOUS_CITATION = r"(?s)قالوا\s*[:\s]\s*(.{5,200})"
NAMED_CITATION = rf"(?s)(?:و)?قال\s+({AR}+(?:\s+{AR}+){{0,2}})\s*[:\s]\s*(.{{5,200}})"
HADITH_TEXT = r"(?s)(?:و)?(?:فى|في)\s+الحديث\s*[:\s]\s*(.{5,200})"
CITED_LENGTH = 200

USAGE_CUES = (
    (r"قال\s+الله|قال\s+تعالى|قرآن", "QURANIC"),
    (r"(?:قال\s+الشاعر|قال\s+امرؤ|قال\s+زهير|أنشد|\bشعر\b|بيت\b)", "POETRY"),
    (r"(?:النبي|رسول\s+الله|صلى\s+الله)", "HADITH"),
)

XREF_PHRASE = r"(?:قد\s+مضى|يُنظر|انظر|مرَّ\s+ذكره|تقدَّم|راجع)"

STRENGTH_CUES = (
    (r"\bلَا\s+(?:شكَّ|ريب)\b", "EMPHATIC_ASSERTED"),
    (r"\bوَلَا\s+خلاف\b", "EMPHATIC_ASSERTED"),
    (r"\bيدلُّ\s+على\b|\bأصله\b", "ASSERTED"),
    (r"\bوأَحسَب\b|\bأَظنُّ\b|\bيُشبه\b", "PROBABLE"),
    (r"\bيُقال\b", "POSSIBLE"),
    (r"\bقال\s+(?:فلان|بعض)\b", "REPORTED"),
    (r"\bولا\s+أَرَى\b|\bلا\s+أَعرف\b", "DOUBTFUL"),
    (r"\bوليس\s+بشيء\b|\bولا\s+أَحسبه\b", "REJECTED"),
)

CONFUSIONS = (("وب", "وي"), ("هـ", "ه"), ("ان", "إن"), ("الى", "الي"), ("�", "?"))

NUCLEUS_PATTERNS = (
    r"يدلُّ?\s+على\s+(.{3,80}?)(?:[.،؛]|$)",
    r"والأصلان\s+(.{3,80}?)(?:[.،؛]|$)",
    r"أصل(?:ه|ها|هُ|ان)?\s+(.{3,80}?)(?:[.،؛]|$)",
    rf"(?:^|\s)(?:هو|هي|هما)\s+({AR}+(?:\s+{AR}+){{0,4}})",
    r"يعني\s+(.{3,80}?)(?:[.،؛]|$)",
)
FIRST_WORDS = rf"^[^؀-ۿ]*({AR}+(?:\s+{AR}+){{0,2}})"

SEMANTIC_KINDS = (
    (r"الحركة|الذهاب|الإقبال|الإدبار|يمشي|يسير", "MOTION_KIND"),
    (r"الاجتماع|الالتقاء|الانفراد|الفراق", "EVENT_KIND"),
    (r"الشدة|القوة|اللين|الصلابة|الصفة", "PROPERTY_KIND"),
    (r"الضعف|الوهن|الخوف|الفزع|الحال", "STATE_KIND"),
    (r"فوق|تحت|أمام|خلف|بين|عند", "SPATIAL_KIND"),
    (r"الزمان|الوقت|الحين|المدة", "TEMPORAL_KIND"),
    (r"العدد|الكثرة|القلة|الواحد", "QUANTITY_KIND"),
    (r"النسبة|الإضافة|الصلة|الارتباط", "RELATION_KIND"),
    (r"الوظيفة|الاستعمال|الغاية|المقصد", "FUNCTION_KIND"),
    (r"الحسن|القبح|المدح|الذم|الخير|الشر", "EVALUATIVE_KIND"),
    (r"الرجل|المرأة|الشيء|الأمر|الجسم|شخص", "ENTITY_KIND"),
)
ABSTRACTION_LEVELS = (
    (r"الفكر|المعنى|التصور|الذهن|المفهوم", "MENTAL_STATE"),
    (r"العرف|العادة|التقليد|الاجتماع", "SOCIAL_CONVENTION"),
    (r"النسبة|الإضافة|الصلة", "ABSTRACT_RELATION"),
    (r"الحركة|الفعل|العمل|الصنع", "PHYSICAL_PROCESS"),
    (r"الجسم|المادة|الشيء\s+الملموس|الجسماني", "CONCRETE"),
)
TEMPORAL_PROFILES = (
    (r"يدوم|دائم|مستمر|لا\s+ينقطع", "DURATIVE"),
    (r"مرة|لحظة|بغتة|فجأة|وثبة", "PUNCTUAL"),
    (r"صفة|حال|كون|وصف", "STATIC"),
    (r"يتكرر|مرات|أحياناً", "ITERATIVE"),
    (r"يحدث|يقع|يجري|يسير", "DYNAMIC"),
    (r"أثر|نتيجة|ما\s+بقي", "RESULT_STATE"),
)
BRANCH_RELATIONS = (
    (r"شُبِّه\b|شبَّه|يشبه\b|تشبيه", "SIMILARITY_EXTENSION"),
    (r"مجاز|على\s+المجاز", "METAPHORICAL_EXTENSION"),
    (r"لأنَّ?ه\s+يُشبه", "SIMILARITY_EXTENSION"),
    (r"سُمِّي.*لأن", "NAMING_BY_PROPERTY"),
    (r"سُمِّي.*بِ", "NAMING_BY_EFFECT"),
    (r"آلة|أداة", "INSTRUMENT_OF"),
    (r"جمع|جُمُوع", "SPECIALIZATION"),
    (r"مكان|موضع|محل", "LOCATION_OF"),
    (r"فاعل|من\s+يفعل", "AGENT_OF"),
    (r"نتيجة|أثر|يسبب", "RESULT_OF"),
    (r"جزء|بعض", "PART_OF"),
)
SEMANTIC_DISTANCES = (
    (r"على\s+المجاز|مجازاً", "METAPHORICAL"),
    (r"استعارة", "METAPHORICAL"),
    (r"تشبيه|يشبه", "EXTENDED"),
    (r"مشتق\s+من|اشتقاقه\s+من", "DIRECT"),
)
DOMAINS = (
    (r"الخيل|الإبل|الناقة|البعير|الفرس", "ANIMAL"),
    (r"الشجر|النبات|الزرع|الثمر", "PLANT"),
    (r"العين|الرأس|اليد|القدم|الظهر", "ANATOMY"),
    (r"مشى|سار|جرى|وثب|ركض", "MOTION"),
    (r"لون|أبيض|أسود|أحمر|أخضر", "COLOR"),
    (r"صوت|نطق|كلام|قول", "SOUND"),
    (r"عقل|فهم|علم|معرفة", "COGNITION"),
    (r"حكم|قضاء|شريعة|فقه", "LEGAL"),
    (r"صلاة|زكاة|حج|إيمان|دين", "RELIGIOUS"),
    (r"سيف|رمح|قوس|سلاح", "ARTIFACT"),
    (r"قبيلة|قوم|أهل|عشيرة", "SOCIAL"),
)
XREF_TARGET = (r"(?:في|فى|في\s+باب|انظر)\s+(?:(?:باب|فصل)\s+)?"
               r"([؀-ۿ]+(?:\s+[؀-ۿ]+){0,2})")
EVENT_KINDS = (
    (r"حركة|تحرك|ذهاب|مشي|سير|عبور", "MOTION"),
    (r"كلام|قول|نطق|خبر|بلاغ", "COMMUNICATION"),
    (r"صنع|خلق|إنشاء|تأليف|إيجاد", "CREATION"),
    (r"كسر|هدم|إفساد|تدمير|إتلاف", "DESTRUCTION"),
    (r"نقل|إعطاء|تسليم|أخذ|أخذ\s+من", "TRANSFER"),
    (r"رؤية|سمع|إدراك|شعور|إحساس", "PERCEPTION"),
    (r"فكر|علم|معرفة|تذكر|نسيان", "COGNITION"),
    (r"تغيّر|تحوّل|انقلب|صار\b", "STATE_TRANSITION"),
    (r"فعل|عمل|نشاط|سعي", "ACTION"),
)
OPPOSITIONS = (
    (r"ضد|نقيض|عكس", "LEXICAL_ONLY"),
    (r"ليس\s+بـ?|ليس\s+هو|لا\s+يُقال", "COMPLEMENTARY"),
    (r"مقابل|في\s+مقابل", "GRADABLE"),
)
SELF_MARKERS = ("يقال", "يقولون", "قيل", "من ذلك", "ومن الباب", "ومما شذّ", "أصله", "والجمع")

# Page-line patterns.
NAMES = "|".join(sorted(LETTER_NAMES, key=len, reverse=True))
GEMINATE_PREFIX = r"(?:وأمّ?ا?\s+|وللـ?\s*|و)"
LINE_PATTERNS = {
    "chapter": r"^(?:كتاب|باب|فصل)\s+[؀-ۿ]",
    "bracket": r"^\[([؀-ۿّ]{1,6})\]\s*$",
    "confirm": rf"^(?:{GEMINATE_PREFIX})?(?:{NAMES})\s+(?:و\s*(?:{NAMES}))",
    "strict": (rf"^({NAMES})(?:\s+و\s*(?:{NAMES}))*(?:\s+وما\s+يثلثهما|\s+في\s+|)?"
               r".{0,60}?(?:أصلٌ|أصل\s+واح|وجهان|أصلان|يدلّ|يدل\s+على)"),
    "geminate": rf"^{GEMINATE_PREFIX}(?:{NAMES})\s+(?:و\s*(?:{NAMES}))",
    "footnote": r"^\s*[\(\（]\s*[١٢٣٤٥٦٧٨٩٠0-9]{1,2}\s*[\)\）]",
    "poetry": r"[؀-ۿ\p{L}\p{N}_].{5,}\s…\s.{5,}[؀-ۿ\p{L}\p{N}_]",
    "page_ref": r"[\[\(]ص\s*([٠-٩0-9]+)[\]\)]|[\[\(]([٠-٩0-9]+)\s*:\s*[٠-٩0-9]+[\]\)]",
}
# ------------------------------------------------------------ end fixed values


def _pack(name: str, pats: dict[str, str], chain: str, gap: str, second_prefix: str,
          bare_word: str, uncertain_window: int, word_last: bool, **extra) -> OriginPack:
    p = {k: J(v) for k, v in pats.items()}
    word = OriginRule("word", p["word"], "SINGLE_WORD", 1, (1,))
    most = OriginRule("most", p["most"], "SINGLE_ORIGIN", 1, (1,))
    bare = OriginRule("bare_word", J(bare_word), "SINGLE_WORD", 1, (1, 2) if word_last else (),
                      first_only=True, extract=p["word"] if word_last else None)
    rules = [
        OriginRule("no_root", p["no_root"], "NO_ROOT_OR_UNCERTAIN", 0),
        OriginRule("uncertain", p["uncertain"], "UNCERTAIN", None, window=uncertain_window),
        OriginRule("two", p["two"], "MULTI_ORIGIN", 2, (1, 2)),
        OriginRule("three", p["three"], "MULTI_ORIGIN", 3, (1, 2)),
        OriginRule("four", p["four"], "MULTI_ORIGIN", 4, (1,)),
        OriginRule("single", p["single"], "SINGLE_ORIGIN", 1, (1, 2), first_only=True),
        OriginRule("denotes", p["denotes"], "SINGLE_ORIGIN", 1, (1,)),
        *((bare, most) if word_last else (word, most, bare)),
        OriginRule("denotes_near", J(DENOTES_ANYWHERE), "SINGLE_ORIGIN", 1, (1,), window=300),
    ]
    if not word_last:
        rules.append(OriginRule("one_origin", J(ONE_ORIGIN), "SINGLE_ORIGIN", 1, (1,),
                                extract=J(ONE_ORIGIN_TEXT), extract_window=400))
    return OriginPack(
        name=name,
        profile=PROFILES["classify_v1" if word_last else "classify"],
        chains=(J(rf"^{chain}{gap}([\s\S]{{1,400}})"),
                J(rf"^(?:{second_prefix}|و){chain}{gap}([\s\S]{{1,400}})")),
        context_prefixes=extra.get("context_prefixes", ()),
        rules=tuple(rules),
        authorities="|".join(AUTHORITIES),
        ocr_suspect=OCR_SUSPECT,
        noise=extra.get("noise"),
        pre_strip=extra.get("pre_strip"),
        raw_prefix=extra.get("raw_prefix"),
    )


ORIGINS_V2 = _pack(
    "v2", ORIGIN_PATTERNS_V2, CHAIN_V2, GAP_V2, r"وأم?ا?\s+", BARE_WORD_V2, 100, False,
    noise=r"\s*\*\s*", pre_strip=PROFILES["marks_only"],
    context_prefixes=(J(r"^في\s+المضاعف\s*"), J(r"^مضاعف[ةه]?\s*"),
                      J(r"^(?:وما|ما)\s+بعده?(?:ما|م)?\s+(?:من\s+)?المعتل?\s*")),
)
ORIGINS_V1 = _pack("v1", ORIGIN_PATTERNS_V1, CHAIN_V1, GAP_V1, r"وام?ا?\s+", BARE_WORD_V1,
                   120, True, raw_prefix=J(r"^المعتل?\s*"))

LINES = LinePack(
    **{k: J(v) for k, v in LINE_PATTERNS.items()}, page_ref_groups=2, letter_names=LETTER_NAMES,
)


def _rules(pairs):
    return tuple((J(pattern), label) for pattern, label in pairs)


CLAIM_RULES = (
    *(ClaimRule(seg, claim, J(rx), term, definition)
      for seg, claim, rx, term, definition in CLAIM_PATTERNS),
    ClaimRule("AUTHORITY", "AUTHORITY_CITATION", J(ANONYMOUS_CITATION), 0, 1, authority=ANONYMOUS,
              definition_limit=CITED_LENGTH, requires=ANONYMOUS),
    ClaimRule("AUTHORITY", "AUTHORITY_CITATION", J(NAMED_CITATION), 0, 2, authority=1,
              definition_limit=CITED_LENGTH),
    ClaimRule("HADITH", "HADITH_EVIDENCE", J(HADITH_TEXT), 0, 1, definition_limit=CITED_LENGTH),
)

DISCOURSE = DiscoursePack(
    markers=tuple(Marker(n, t, J(p)) for n, t, p in MARKERS),
    split_order=SPLIT_ORDER,
    ocr_fix=(J(r"\bوبقال\b"), "ويقال"),
    claim_rules=CLAIM_RULES,
    authority_trail=J(r"[،:.؛\s]+$"),
    anonymous=ANONYMOUS,
    self_markers=SELF_MARKERS,
    hedge=J(r"كأنَّ?"),
    usage_cues=_rules(USAGE_CUES),
    poetry_cue=J(USAGE_CUES[1][0]),
    xref_phrase=J(XREF_PHRASE),
    strength_cues=_rules(STRENGTH_CUES),
    confusions=CONFUSIONS,
    script_class="؀-ۿ",
    boundary_probe="والأصل الآخر",
    boundary_split=J(r"والأصل\s+الآخر|والثاني\b|فالأول\b"),
    nucleus_rules=tuple(J(p) for p in NUCLEUS_PATTERNS),
    first_words=J(FIRST_WORDS),
    semantic_kinds=_rules(SEMANTIC_KINDS),
    abstraction=_rules(ABSTRACTION_LEVELS),
    temporal=_rules(TEMPORAL_PROFILES),
    relations=_rules(BRANCH_RELATIONS),
    distances=_rules(SEMANTIC_DISTANCES),
    domains=_rules(DOMAINS),
    xref_target=J(XREF_TARGET),
    event_kinds=_rules(EVENT_KINDS),
    oppositions=_rules(OPPOSITIONS),
    term_profile=PROFILES["graph_term"],
    origin_profile=PROFILES["graph_origin"],
    entity_profile=PROFILES["entity"],
)
