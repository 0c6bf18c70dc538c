"""Panel time-series preparation on Spark DataFrames."""

from longspan.config import FeatureConfig, PanelSpec, SequenceConfig, SplitConfig

__all__ = ["FeatureConfig", "PanelSpec", "SequenceConfig", "SplitConfig"]
