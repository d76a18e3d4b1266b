"""Data-mining operators as DataFrame -> DataFrame functions."""
