"""Error classes raised by the engine."""


class DataLoadError(Exception):
    """A table cannot be read, or has no rows."""


class DataValidationError(Exception):
    """A table cannot be used at all (no rows, no target, only missing targets)."""


class SchemaValidationError(Exception):
    """A table lacks columns that the fitted features need."""


class AmbiguousKeyError(ValueError):
    """The row key does not identify rows, so an exact split is not defined."""


class ThresholdSelectionError(Exception):
    """No threshold meets the requested floor."""


class CalibrationError(Exception):
    """Calibration settings are not supported, or calibration cannot be fitted."""


class AttributionError(Exception):
    """A model cannot be attributed."""


class BundleLoadError(Exception):
    """A model version, or a part of it, is missing or invalid."""
