"""The end-to-end preprocessor as an Estimator/Model pair.

``fit`` builds the features (E1) on training rows, splits them into
categorical and numeric roles and fits the frequency maps (E5);
``transform`` applies the same to any frame (batch or stream) and renders
categoricals as strings with 'nan' for missing values. A Model exists only
after ``fit``, which is the "fit first" guard of the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame

from faresight.operators.encode import FrequencyEncoder, categorical_strings
from faresight.operators.features import engineer_features, split_roles
from faresight.roles import ENGINEERED_CAT, FLIGHT_ROLES, Roles


class FarePreprocessor(Estimator):
    def __init__(self, roles: Roles = FLIGHT_ROLES, keep: Sequence[str] = (), cat_candidates=ENGINEERED_CAT):
        super().__init__()
        self.roles, self.keep, self.cat_candidates = roles, list(keep), tuple(cat_candidates)

    def _fit(self, raw: DataFrame) -> "FarePreprocessorModel":
        x = engineer_features(raw, self.roles, keep=self.keep)
        feats = x.drop(*self.keep)
        cats, _ = split_roles(feats, self.cat_candidates)
        freq_cols = [c for c in self.roles.freq if c in feats.columns]
        enc = FrequencyEncoder(freq_cols).fit(feats)
        nums = [c for c in feats.columns if c not in cats] + [f"{c}_freq" for c in freq_cols]
        return FarePreprocessorModel(self.roles, self.keep, cats, nums, list(feats.columns), enc)


class FarePreprocessorModel(Model):
    def __init__(self, roles, keep, cat_cols, num_cols, feature_order, freq_model):
        super().__init__()
        self.roles, self.keep = roles, list(keep)
        self.cat_feature_names, self.num_feature_names = list(cat_cols), list(num_cols)
        self.feature_order, self.freq_model = list(feature_order), freq_model

    @property
    def cat_feature_indices(self) -> list[int]:
        cols = self.columns
        return [cols.index(c) for c in self.cat_feature_names]

    @property
    def columns(self) -> list[str]:
        return self.feature_order + [f"{c}_freq" for c in self.freq_model.inputCols]

    @property
    def freq_maps(self) -> DataFrame:
        return self.freq_model.freq_maps

    def _transform(self, raw: DataFrame) -> DataFrame:
        keep = [c for c in self.keep if c in raw.columns]  # a scoring frame may lack the label
        x = engineer_features(raw, self.roles, keep=keep)
        x = self.freq_model.transform(x)
        x = categorical_strings(x, self.cat_feature_names)
        return x.select(*self.columns, *keep)
