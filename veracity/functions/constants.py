"""Fixed values that results depend on.

FIXED VALUES - these must stay exactly as they are for results to match the
behaviour being reproduced (vocabularies, codes, weights, thresholds, texts).
"""

# --- fixed values: question prefix (DOCX code, first two letters) -> question type
QUESTION_PREFIX_TYPE = {
    "Нв": "neutral",
    "Пв": "control",
    "Вл": "probable_lie",
    "Жв": "sacrifice",
    "Св": "symptomatic",
}

# --- fixed values: archive type code -> question type (tabular path)
TYPE_CODE_TO_TYPE = {
    "I": "neutral",
    "R": "control",
    "C": "probable_lie",
    "SR": "sacrifice",
    "S": "symptomatic",
    "B": "other",
    "DL": "probable_lie",
}

# --- fixed values: archive type code -> Russian type name (default "Прочее")
TYPE_CODE_RU = {
    "I": "Нейтральный",
    "R": "Проверочный",
    "C": "Вероятной лжи",
    "SR": "Жертвенный проверочный",
    "S": "Симптоматический",
    "B": "Вводный вопрос",
    "DL": "Вопрос управляемой лжи",
}
TYPE_RU_DEFAULT = "Прочее"

# --- fixed values: archive type code -> short question code prefix (default: the code)
TYPE_CODE_SHORT = {
    "I": "Нв",
    "R": "Пв",
    "C": "Вл",
    "SR": "Жв",
    "S": "Св",
    "B": "B",
    "DL": "DL",
}

# --- fixed values: canonical type code for direct scoring
TYPE_CODE_CANONICAL = {"B": "I", "DL": "C"}

# --- fixed values: Russian type-name fragments used when the code is unknown
TYPE_RU_FRAGMENTS = [("нейтр", "neutral"), ("контр", "control"), ("провер", "probable_lie"), ("значим", "probable_lie")]

# --- fixed values: raw channel name (upper-cased, trimmed) -> channel
PARAMETER_MAP = {
    "ДЫХАНИЕ": "breath",
    "BREATH": "breath",
    "КГР": "gsr",
    "EDA": "gsr",
    "GSR": "gsr",
    "АД": "bp",
    "AR": "bp",
    "BP": "bp",
    "ПГ": "ppg",
    "PLE": "ppg",
    "PPG": "ppg",
}

# --- fixed values: parameter_norm values treated as junk rows
JUNK_PARAMETERS = ["", "none", "nan", "параметр", "parameter"]

# --- fixed values: sensor id -> display name (default: the id)
SENSOR_NAMES = {
    "ar": "АД (артериальное давление)",
    "bv": "Дыхание (грудной канал)",
    "absbv": "Дыхание (брюшной канал)",
    "eda": "КГР / EDA",
    "ple": "ПГ (плетизмограмма)",
    "tremor": "Тремор",
    "tr": "Двигательная активность",
    "sound": "Аудиоканал",
}

# --- fixed values: direct scoring channel weights, order eda, cardio, resp, ppg
CHANNEL_WEIGHTS = {"eda": 0.45, "cardio": 0.25, "resp": 0.20, "ppg": 0.10}
CHANNELS = ["resp", "eda", "cardio", "ppg"]

# --- fixed values: empirical score weights (resp, eda, bv, ple), divisor 2, clip +-2
EMPIRICAL_WEIGHTS = {"empirical_resp": 0.10, "empirical_eda": 0.55, "empirical_bv": 0.25, "empirical_ple": 0.10}

# --- fixed values: direct scoring constants
MAD_FACTOR = 1.4826
SCALE_EPS = 1e-8
Z_CLIP = 5.0
LOGIT_SLOPE = 1.45
LOGIT_BIAS = -0.10
LOGIT_CLIP = 20.0
R_EMPIRICAL_FACTOR = 0.20
OTHER_BASELINE_FACTOR = 0.35
OTHER_SHRINK = 0.35
PROB_MIN, PROB_MAX = 0.02, 0.98
DIRECT_LABEL_THRESHOLD = 0.55

# --- fixed values: recommendation texts
REC_LIE = "Вероятно ложь"
REC_TRUTH = "Вероятно правда"
REC_EXPERT = "Требует внимания эксперта"
REC_INSUFFICIENT = "Insufficient data"
DIRECT_METHOD = "xdex_direct_scoring_v2_pairwise"

# --- fixed values: recommendation bands
ML_BANDS = (0.60, 0.40)
DIRECT_BANDS = (0.65, 0.35)

# --- fixed values: expected answer words
EXPECTED_YES = ("Truth", "правда")
EXPECTED_NO = ("Lie", "ложь")

# --- fixed values: expert review words
REVIEW_LIE_WORDS = ["ложь", "lie", "1", "true", "yes", "да"]
REVIEW_TRUTH_WORDS = ["правда", "truth", "0", "false", "no", "нет"]

# --- fixed values: the 13 score keys of a stimulus, in order (key in archive, column)
SCORE_KEYS = [
    ("A_BV", "a_bv"),
    ("A_EDA", "a_eda"),
    ("A_EDA2", "a_eda2"),
    ("A_PLE", "a_ple"),
    ("A_ARLENGTH", "a_arlength"),
    ("A_TRLENGTH", "a_trlength"),
    ("Countering_RESP", "counter_resp"),
    ("Countering_TRM", "counter_trm"),
    ("Countering_Answer", "counter_answer"),
    ("Empirical_RESP", "empirical_resp"),
    ("Empirical_BV", "empirical_bv"),
    ("Empirical_EDA", "empirical_eda"),
    ("Empirical_PLE", "empirical_ple"),
]
SCORE_COLUMNS = [c for _, c in SCORE_KEYS]

# --- fixed values: DOCX default header and header words
DOCX_DEFAULT_HEADER = ["Вопрос", "Параметр", "I", "II", "Результат"]

# --- fixed values: feature columns never used as model inputs
EXCLUDED_FEATURES = [
    "label", "label_weak", "label_question_template", "label_bootstrap", "label_hybrid", "label_train",
    "label_source", "label_source_train", "score_result", "label_expert", "expert_label", "expert_review",
    "created_at", "source_file", "source_type", "test_id", "question_code", "question_raw", "question_text",
    "question_type",
]
# --- fixed values: label column preference order
LABEL_CANDIDATES = ["label", "label_train", "label_bootstrap", "label_hybrid", "label_question_template", "label_weak"]

# --- fixed values: threshold search grid and ensemble rules
THRESHOLD_LO, THRESHOLD_HI, THRESHOLD_N = 0.10, 0.90, 161
ENSEMBLE_F1_MARGIN = 0.02
ENSEMBLE_MAX_MEMBERS = 3
ENSEMBLE_MIN_WEIGHT = 0.001
WEAK_LABEL_THRESHOLD = 0.55

# Tags and attributes of XML archives, in order of preference.
XML_QUESTION_TAGS = ("question", "q")
XML_QUESTION_ATTRS = ("text", "name", "code")
XML_CHANNEL_TAGS = ("channel", "sensor", "parameter")
XML_CHANNEL_ATTRS = ("name", "type", "id")
XML_FIRST_TAGS = ("metrici", "i", "value1", "first")
XML_SECOND_TAGS = ("metricii", "ii", "value2", "second")
XML_SCORE_TAGS = ("result", "score", "index", "probability")
