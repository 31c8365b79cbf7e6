"""Load operators (dims, facts), reports, report layer and quality checks."""
