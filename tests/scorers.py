"""An offline scorer, so that runs and tests need no remote model."""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle

# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = ["payload", "input_tokens", "output_tokens", "thought_tokens", "http_status", "error_kind", "error_message"]


class RuleScorer:
    """Deterministic offline scorer. It rates repetition of stock words, so runs
    and tests need no remote model; it is not a judgement of any review."""

    def __init__(self, stock_words: tuple[str, ...] = ("best", "recommend", "repurchase", "amazing", "推薦", "回購")):
        self.stock_words = stock_words

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in rows["comment_text"]:
            lowered = text.lower()
            hits = [w for w in self.stock_words if w in lowered]
            signals = []
            for word in hits:
                at = lowered.index(word)
                signals.append({"code": "STOCK_PRAISE", "span": text[at : at + len(word)], "start_char": at, "end_char": at + len(word)})
            payload = {
                "shill_score": min(100, 30 * len(hits)),
                "template_detected": len(hits) >= 2,
                "template_id": "stock-" + hits[0] if len(hits) >= 2 else None,
                "template_name": None,
                "linguistic_style": "canned_pr" if len(hits) >= 2 else "unknown",
                "detected_signals": signals,
                "rationale_short": f"{len(hits)} stock words",
            }
            out.append((json.dumps(payload, ensure_ascii=False), len(text), len(signals), 0, None, None, None))
        return pd.DataFrame(out, columns=COLUMNS)
