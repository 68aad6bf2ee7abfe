"""See the package README section of the repository for an overview."""
