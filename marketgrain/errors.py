"""Failures a caller is expected to handle."""


class AnalyticsError(Exception):
    """An analysis was asked for something its input cannot answer."""


class IngestError(AnalyticsError):
    """A file drop is not fit to be loaded."""


class PublishError(AnalyticsError):
    """A batch cannot be published to its target."""
