"""Fixed values that results depend on."""

# Korean formal sentence endings in the aligner's order, longest first.
FORMAL_ENDINGS_LONGEST_FIRST = [
    "것이었습니다", "것입니다", "었습니다", "였습니다", "겠습니다", "었습니까", "였습니까", "겠습니까",
    "하십시오", "마십시오", "습니다", "습니까", "십시오", "십시요", "읍시다", "합시다", "으셨어요", "으세요", "하세요",
]
# The same endings in the truncation detector's order.
FORMAL_ENDINGS_DETECTOR = [
    "습니다", "습니까", "십시오", "십시요", "것입니다", "것이었습니다", "었습니다", "였습니다", "겠습니다",
    "었습니까", "였습니까", "겠습니까", "하십시오", "마십시오", "읍시다", "합시다", "으세요", "하세요", "으셨어요",
]
# The eleven endings of the recount.
FORMAL_ENDINGS_RECOUNT = ["것이었습니다", "것입니다", "었습니다", "였습니다", "겠습니다", "습니다", "습니까", "십시오", "합시다", "으세요", "하세요"]

# Padding around aligned segments (ms).
PAD_MS, MIN_GAP_MS, TAIL_MAX_MS, FORMAL_PAD_MS, GAP_MARGIN_MS = 50, 30, 400, 650, 20
# Envelope and its tolerances (ms), silence levels when trimming and when judging (dB).
PREATTACK_MS, TAIL_MS, PREATTACK_LEAST_MS, TAIL_LEAST_MS = 400, 730, 395, 725
TRIM_DB, JUDGE_DB, FLOOR = -65.0, -40.0, 1e-10
ONSET_SAFETY_MS, OFFSET_SAFETY_MS, FADE_IN_MS, FADE_OUT_MS, PEAK_DB, WINDOW_MS, SAMPLE_RATE = 30, 120, 10, 5, -1.0, 10, 48_000
# Verdict thresholds.
PASS_AT, TYPE_D_LOW, TYPE_D_HIGH, TIER2_FLOOR, GATE_PCT, CURATION_FLOOR, CURATION_MAX_SHARE = 0.95, 0.15, 0.70, 0.50, 95.0, 0.30, 0.20
FAILURE_TYPES = ["A", "B", "C", "D", "E", "F"]
