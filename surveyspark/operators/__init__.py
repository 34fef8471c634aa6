"""Survey operators: linkage, derivations, margins, designs, estimates."""
