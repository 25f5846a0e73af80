"""All encoders of a table: target encodings first, then text."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tallycast.config import EncoderSpec, PanelSpec
from tallycast.operators.guards import present
from tallycast.operators.target_encoding import TargetEncoding, fit_target_encoding, fit_target_encoding_folds
from tallycast.operators.text_encoding import HashEncoding, TfidfEncoding, fit_tfidf, fit_tfidf_folds

TEXT_METHODS = ("tfidf", "hashing")


def route_columns(columns: Iterable[str]) -> tuple[list[str], list[str]]:
    """Split into (target-encoded, text): a name that contains ``desc`` is text."""
    columns = list(columns)
    text = [c for c in columns if "desc" in c.lower()]
    return [c for c in columns if c not in text], text


@dataclass
class Encoders:
    target: TargetEncoding | None = None
    text: list[TfidfEncoding | HashEncoding] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        """Names of all produced features, vectors spelled out."""
        out = list(self.target.names) if self.target else []
        for t in self.text:
            out += t.names
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        if self.target:
            df = self.target.apply(df)
        for t in self.text:
            df = t.apply(df)
        return df


def check_method(spec: EncoderSpec) -> None:
    if spec.text_method not in TEXT_METHODS:
        raise ValueError(f"text_method must be one of {TEXT_METHODS}, not {spec.text_method!r}")


def fit_encoders(
    df: DataFrame,
    target_cols: Iterable[str],
    text_cols: Iterable[str],
    label: str,
    spec: EncoderSpec = EncoderSpec(),
) -> Encoders:
    check_method(spec)
    target_cols, text_cols = present(df, target_cols), present(df, text_cols)
    target = fit_target_encoding(df, target_cols, label, spec) if target_cols else None
    if spec.text_method == "tfidf":
        text = [fit_tfidf(df, c, spec) for c in text_cols]
    else:
        text = [HashEncoding(c, spec) for c in text_cols]
    return Encoders(target, text)


def fit_panel_encoders(
    df: DataFrame,
    panel: PanelSpec = PanelSpec(),
    spec: EncoderSpec = EncoderSpec(),
    *,
    encode_ids: bool = True,
) -> Encoders:
    """Encoders for a panel, columns routed by name; ID categories included."""
    target_cols, text_cols = panel_columns(panel, encode_ids, spec)
    return fit_encoders(df, target_cols, text_cols, panel.label_col, spec)


def panel_columns(panel: PanelSpec, encode_ids: bool = True, spec: EncoderSpec = EncoderSpec()) -> tuple[list[str], list[str]]:
    """The columns to target-encode and those with text."""
    target_cols, text_cols = route_columns(panel.high_cardinality_cols)
    if encode_ids:
        target_cols += [c for c in panel.numeric_id_cols if c not in target_cols]
    target_cols += [c for c in spec.ordered_cols if c not in target_cols]
    return target_cols, [c for c in text_cols if c not in spec.ordered_cols]


def fit_panel_encoders_folds(df: DataFrame, n_folds: int, panel: PanelSpec = PanelSpec(), spec: EncoderSpec = EncoderSpec()) -> list[Encoders]:
    """``fit_panel_encoders`` of the training rows of every fold; ``df`` carries ``first_train_fold`` and is read as often as for one."""
    check_method(spec)
    target_cols, text_cols = (present(df, c) for c in panel_columns(panel, spec=spec))
    target: list = [None] * n_folds
    if target_cols:
        target = fit_target_encoding_folds(df, target_cols, panel.label_col, n_folds, spec)
    if spec.text_method == "tfidf":
        text = [fit_tfidf_folds(df, c, n_folds, spec) for c in text_cols]
    else:
        text = [[HashEncoding(c, spec)] * n_folds for c in text_cols]
    return [Encoders(target[k], [t[k] for t in text]) for k in range(n_folds)]
