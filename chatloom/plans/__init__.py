"""Workspace model, job options, staging and the end-to-end job."""
