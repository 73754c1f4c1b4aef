"""The prompt schemas of the six data types and of the four brainstorms.

The templates are worded here; argument names, values, weights, constraints and reply keys are
fixed values. A schema file of one's own loads with ``PromptSchema.from_json``.
"""

from __future__ import annotations

from pairsmith.operators.schema import PromptSchema

# --- fixed values ----------------------------------------------------------------------------
# Languages in their order; "Burmese" stands twice, and both places can be drawn.
LANGUAGES = [
    "English", "Arabic", "Chinese", "Dutch", "French", "German", "Indonesian", "Italian", "Japanese", "Persian",
    "Polish", "Portuguese", "Russian", "Spanish", "Afrikaans", "Albanian", "Amharic", "Armenian", "Assamese",
    "Azerbaijani", "Basque", "Belarusian", "Bengali", "Bengali Romanized", "Bosnian", "Breton", "Burmese",
    "Burmese", "Catalan", "Croatian", "Czech", "Danish", "Esperanto", "Estonian", "Filipino", "Finnish",
    "Galician", "Georgian", "Greek", "Gujarati", "Hausa", "Hebrew", "Hindi", "Hindi Romanized", "Hungarian",
    "Icelandic", "Irish", "Javanese", "Kannada", "Kazakh", "Khmer", "Korean", "Kurdish", "Kyrgyz", "Lao", "Latin",
    "Latvian", "Lithuanian", "Macedonian", "Malagasy", "Malay", "Malayalam", "Marathi", "Mongolian", "Nepali",
    "Norwegian", "Oriya", "Oromo", "Pashto", "Punjabi", "Romanian", "Sanskrit", "Scottish Gaelic", "Serbian",
    "Sindhi", "Sinhala", "Slovak", "Slovenian", "Somali", "Sundanese", "Swahili", "Swedish", "Tamil",
    "Tamil Romanized", "Telugu", "Telugu Romanized", "Thai", "Turkish", "Ukrainian", "Urdu", "Urdu Romanized",
    "Uyghur", "Uzbek", "Vietnamese", "Welsh", "Western Frisian", "Xhosa", "Yiddish",
]
# English, then the 13 other large languages, then all others.
LANGUAGE_WEIGHTS = [0.431] + [0.029] * 13 + [0.0022857142857142824] * 84
SCHOOL_LEVELS = ["elementary school", "high school", "college"]
STUDY_LEVELS = ["high school", "college", "PhD"]
CLARITY = ["clear", "understandable with some effort", "ambiguous"]
NUM_WORDS = ["50", "100", "200", "300", "400", "500"]
QUERY_TYPES = ["extremely long-tail", "long-tail", "common"]
QUERY_LENGTHS = ["less than 5 words", "5 to 15 words", "at least 10 words"]
UNITS = ["sentence", "phrase", "passage"]
HIGH_SCORES = ["4", "4.5", "5"]
LOW_SCORES = ["1.5", "2", "2.5"]
# The query and document texts that are embedded to find hard negatives.
QUERY_TEMPLATE = "Instruct: {instruction}\nQuery: {query}"
DOCUMENT_TEMPLATE = "{positive}"
SYSTEM_PROMPT = "You are a helpful assistant."
BRAINSTORM_PARAMS = {"temperature": 1.0, "top_p": 0.9, "max_tokens": 4096}
GENERATION_PARAMS = {"temperature": 0.8, "top_p": 0.9, "max_tokens": 4096}
# --- end of fixed values ---------------------------------------------------------------------

ANSWER_RULE = "Answer with the JSON object alone, and vary topics and style."

TEMPLATES = {
    "short_long": (
        "This is your retrieval task: {task}\n"
        "Invent one example of it as a JSON object with the string fields \"user_query\" (what somebody searches), "
        "\"positive_document\" (a text that serves the query) and \"hard_negative_document\" (a text that looks "
        "fitting but helps less).\n"
        "Make the query {query_type}, {query_length} and {clarity}. Give each document {num_words} words or more, "
        "written without looking at the query. Use {language}, for readers with a {difficulty} education.\n"
    ) + ANSWER_RULE,
    "long_short": (
        "This is your classification task: {task}\n"
        "Invent one example of it as a JSON object with the string fields \"input_text\", \"label\" (the right "
        "class) and \"misleading_label\" (a wrong class that belongs to the task).\n"
        "Write an input text of {num_words} words in {language} that is {clarity}, for readers with a {difficulty} "
        "education, and does not spell out either label.\n"
    ) + ANSWER_RULE,
    "long_long": (
        "This is your matching task: {task}\n"
        "Invent one example of it as a JSON object with the string fields \"input\" and \"positive_document\" (a "
        "text that matches the input).\n"
        "Both are long texts in {language}, 300 words or more each, that share few words.\n"
    ) + ANSWER_RULE,
    "short_short": (
        "This is your matching task: {task}\n"
        "Invent one example of it as a JSON object with the string fields \"input\" and \"positive_document\" (a "
        "text that matches the input).\n"
        "Both are a phrase or a sentence in {language}, and share few words.\n"
    ) + ANSWER_RULE,
    "sts": (
        "Invent three texts in {language}, each one {unit}, as a JSON object with the string fields \"S1\", \"S2\" "
        "and \"S3\".\n"
        "On a scale of similarity from 1 to 5, S1 and S2 reach {high_score} and S1 and S3 reach {low_score}. They "
        "share some words and suit readers with a {difficulty} education.\n"
    ) + ANSWER_RULE,
    "bitext": (
        "Invent one {unit} in {src_lang} and two translations into {tgt_lang}, as a JSON object with the string "
        "fields \"S1\" (the original), \"S2\" and \"S3\".\n"
        "On a scale of translation quality from 1 to 5, S2 reaches {high_score} and S3 reaches {low_score}: fluent, "
        "with wrong, missing or added content. S1 suits readers with a {difficulty} education.\n"
    ) + ANSWER_RULE,
}

LIST_RULE = "Answer with a Python list of about 20 strings alone, one sentence for each task."
BRAINSTORMS = {
    "short_long": "Think of many text retrieval tasks. Say what is searched and which documents are wanted.\n" + LIST_RULE,
    "long_short": "Think of many text classification tasks from different domains.\n" + LIST_RULE,
    "long_long": "Think of many text matching tasks in which both sides are long documents.\n" + LIST_RULE,
    "short_short": "Think of many text matching tasks in which both sides are a phrase or a sentence.\n" + LIST_RULE,
}


def _arguments(data_type: str) -> dict[str, list[str]]:
    if data_type == "short_long":
        return {"query_type": QUERY_TYPES, "query_length": QUERY_LENGTHS, "difficulty": STUDY_LEVELS,
                "clarity": CLARITY, "num_words": NUM_WORDS, "language": LANGUAGES}
    if data_type == "long_short":
        return {"difficulty": STUDY_LEVELS, "clarity": CLARITY, "num_words": NUM_WORDS, "language": LANGUAGES}
    if data_type in ("long_long", "short_short"):
        return {"language": LANGUAGES}
    scored = {"high_score": HIGH_SCORES, "low_score": LOW_SCORES, "unit": UNITS, "difficulty": SCHOOL_LEVELS}
    if data_type == "sts":
        return {**scored, "language": LANGUAGES}
    if data_type == "bitext":
        return {**scored, "src_lang": LANGUAGES, "tgt_lang": LANGUAGES}
    raise ValueError(f"unknown data type {data_type!r}")


def schema_for(data_type: str, tasks=None) -> PromptSchema:
    """The schema of a data type; the four task types need ``tasks``, a list, path or ``ValueList``."""
    args = {name: list(values) for name, values in _arguments(data_type).items()}
    weights = {name: list(LANGUAGE_WEIGHTS) for name in args if name in ("language", "src_lang", "tgt_lang")}
    if data_type in BRAINSTORMS:
        if tasks is None:
            raise ValueError(f"{data_type} draws from a list of tasks")
        args["task"] = tasks
    constraints = [{"type": "neq", "value1": "src_lang", "value2": "tgt_lang"}] if data_type == "bitext" else None
    return PromptSchema(TEMPLATES[data_type], args, weights, constraints)


def brainstorm_schema(data_type: str) -> PromptSchema:
    return PromptSchema(BRAINSTORMS[data_type])
