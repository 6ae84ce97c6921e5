"""DataFrame to DataFrame operators of the silver, staging and gold layers."""
