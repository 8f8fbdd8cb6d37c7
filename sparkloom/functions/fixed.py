"""Fixed values that results depend on: patterns, word lists, weights and limits."""

# --- fixed values: text cleaning -------------------------------------------------------------------------------
MIN_LENGTH, MAX_LENGTH, MIN_STRIPPED = 50, 100000, 50
LANGUAGES = ["en", "zh"]
BOILERPLATE = [
    r"Cookie\s+Policy.*?Accept",
    r"Terms\s+of\s+Service.*?Agree",
    r"Privacy\s+Policy.*?Accept",
    r"Subscribe\s+to\s+our\s+newsletter",
    r"Follow\s+us\s+on\s+(Twitter|Facebook|Instagram)",
    r"Copyright\s+©\s+\d{4}.*?All\s+rights\s+reserved",
]
TECHNICAL = [r"\b(however|therefore|furthermore|moreover)\b", r"\b(analysis|research|study|theory)\b", r"\d+\.\d+", r"\b[A-Z]{2,}\b"]
INFORMAL = [r"\b(lol|omg|wtf|idk)\b", r"[!]{2,}"]
CHAR_RUN, WORD_RUN, LINE_RATIO = 50, 5, 0.3
MOST_PERPLEXITY = 1000.0

# --- fixed values: images with text ----------------------------------------------------------------------------
LEAST_BYTES, MOST_BYTES = 1024, 50 * 1024 * 1024
CAPTION_CHARS = (10, 1000)
CAPTION_LENGTHS, CAPTION_CONFIDENCE = (10, 500), 0.5
CAPTION_MODELS = {"qwen2_vl": ("Generated caption for image using Qwen2-VL model", 0.9), "llava": ("Generated caption for image using LLaVA model", 0.85), "blip2": ("Generated caption for image using BLIP-2 model", 0.8), "generic": ("Generated caption for image", 0.75)}

# --- fixed values: quality filter and scorer -------------------------------------------------------------------
ACADEMIC = ["研究", "分析", "理论", "方法", "结果", "research", "analysis", "theory", "method", "result"]
CITATION_ZH, CITATION_EN = "参考文献", "reference"
TEXT_WEIGHTS = (0.3, 0.3, 0.4)
TOPIC = ["研究", "分析", "结论", "方法", "结果", "research", "analysis", "method", "result"]
CONNECTORS = ["因此", "所以", "但是", "然而", "此外", "首先", "其次", "therefore", "so", "but", "however", "moreover", "first", "second"]
STOPWORDS = ["的", "是", "在", "和", "了", "the", "is", "are", "was", "were", "and", "or", "but"]
SENSITIVE = ["暴力", "色情", "赌博", "violence", "porn", "gambling"]
QUALITY_GATE, SCORER_PASS = 0.5, 0.6

# --- fixed values: safety and toxicity -------------------------------------------------------------------------
RISK_WORDS = {
    "violence": ["杀", "死", "暴力的", "血腥", "kill", "death", "violent", "bloody"],
    "hate_speech": ["种族歧视", "性别歧视", "仇恨", "racist", "sexist", "hate"],
    "sexual_content": ["色情", "性", "porn", "sex", "nude"],
    "self_harm": ["自杀", "自残", "suicide", "self-harm"],
}
RISK_THRESHOLD = 0.7
HATE = [r"讨厌.*种族", r"仇恨.*民族", r"hate\s+.*people", r"kill\s+all"]
#: Scores of a text on which no rule fires, and of one on which the rule of that name does.
TOXICITY_BASE = {"toxicity": 0.1, "severe_toxicity": 0.05, "identity_attack": 0.05, "insult": 0.1, "profanity": 0.1, "threat": 0.05, "sexually_explicit": 0.05}
TOXICITY_HIT = {"profanity": 0.9, "identity_attack": 0.8, "threat": 0.9}
TOXICITY_LIMITS = {"toxicity": 0.7, "identity_attack": 0.7, "profanity": 0.8, "threat": 0.7}
PROFANITY_ZH: list[str] = []
PROFANITY_EN: list[str] = []
IMAGE_RISKS = {"nsfw": 0.1, "violence": 0.1, "sexual_content": 0.1}
IMAGE_CONFIDENCE = 0.9
THREAT = [r"我要杀", r"你死定了", r"i\s+will\s+kill", r"you\s+will\s+die", r"威胁", r"threat"]

# --- fixed values: personal data -------------------------------------------------------------------------------
PII = {
    "PHONE_NUMBER": r"(?:\+?86)?1[3-9]\d{9}",
    "ID_CARD": r"\b[1-9]\d{5}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dXx]\b",
    "BANK_CARD": r"\b\d{16,19}\b",
    "PERSON": "[一-龥]{2,4}(?:说|表示|认为|称|指出|透露|表示)",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "EMAIL_ADDRESS": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
}

#: Scores of the strict rules; cards must pass the Luhn test and addresses have parts of at most 255.
PII_STRICT = {"PHONE_NUMBER": 0.95, "ID_CARD": 0.95, "BANK_CARD": 0.9, "IP_ADDRESS": 0.9}

# --- fixed values: questions and answers -----------------------------------------------------------------------
QUESTION_TYPES = ["factual", "inferential", "conceptual"]
QUESTIONS, LEAST_CONFIDENCE = 3, 0.5
QUESTION_CHARS, ANSWER_CHARS = (10, 200), (20, 1000)
SENTENCE_ENDS = "[。！？.!?]"
ENTITY = r"[A-Z][a-z]+\s[A-Z][a-z]+|[A-Z][a-z]+"
NUMBER = r"\d+(?:\.\d+)?(?:万|亿|百万)?"

# --- fixed values: scores of what has no model here ------------------------------------------------------------
IMAGE_SCORES, IMAGE_WEIGHTS = {"aesthetic": 0.5, "clarity": 0.5, "safe": 1.0}, {"aesthetic": 0.4, "clarity": 0.3, "safe": 0.3}
AUDIO_SCORES, AUDIO_WEIGHTS = {"snr": 0.5, "clarity": 0.5, "speaker_quality": 0.5}, {"snr": 0.4, "clarity": 0.3, "speaker_quality": 0.3}
ALIGNMENT, SCORER_IMAGE = 0.5, {"aesthetic": 0.75, "clarity": 0.8, "alignment": 0.7}

# --- fixed values: words written together ----------------------------------------------------------------------
CONTRACTIONS = {"can't": "cannot", "won't": "will not", "n't": " not", "'re": " are", "'ve": " have", "'ll": " will", "'m": " am"}

# --- fixed values: repositories as texts -----------------------------------------------------------------------
REPOSITORY = "\nRepository: %s\nDescription: %s\nLanguage: %s\nStars: %s\nURL: %s\n"

# --- fixed values: stores --------------------------------------------------------------------------------------
MIME = {
    ".txt": "text/plain", ".json": "application/json", ".jsonl": "application/jsonl", ".csv": "text/csv", ".jpg": "image/jpeg", ".jpeg": "image/jpeg",
    ".png": "image/png", ".webp": "image/webp", ".mp3": "audio/mpeg", ".wav": "audio/wav", ".mp4": "video/mp4", ".avi": "video/x-msvideo",
    ".parquet": "application/parquet", ".bin": "application/octet-stream", ".pt": "application/octet-stream", ".pth": "application/octet-stream",
}
MIME_DEFAULT = "application/octet-stream"
