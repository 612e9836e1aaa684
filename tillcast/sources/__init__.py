"""Sources and sinks."""

from tillcast.sources.readers import read_panel, read_panel_csv
from tillcast.sources.sinks import (forecast_frame, forecast_preview, forecast_quality,
                                    forecast_summary, write_forecast)
from tillcast.sources.star import panel_dense, panel_from_star

__all__ = ["read_panel", "read_panel_csv", "panel_from_star", "panel_dense", "forecast_frame",
           "write_forecast", "forecast_quality", "forecast_summary", "forecast_preview"]
