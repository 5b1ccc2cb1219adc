"""Readers that turn documents, landed API pages or plain tables into a workspace, and payload sinks."""
